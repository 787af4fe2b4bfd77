"""Cross-tokenizer alignment by pointer jumping (operator 12).

Every text, with a leading space, is cut by a byte-level BPE (A) and by a piece model
with byte fallback (B).  The tokens of a block of texts are byte ranges over one long
byte string:

1. Every token points to its farthest-right overlapping token: a token of A to the token
   of B that holds its last byte, a token of B to the token of A that holds its last byte,
   or to itself where both end there.
2. Successor doubling, ``s = s[s]`` for all tokens at once, converges after about
   log2(longest chain) steps to the terminal token of every component, its label.
   The labels are the groups between the byte offsets where tokens of both end.
3. Links are the overlapping pairs of tokens of A and B; there is one per stretch between
   two neighbouring token ends.  The distinct id pairs of a text are kept with the number
   of their links.
4. Over the corpus, the documents of every id pair are counted: summed in every task first,
   then shuffled by pair.  The commonest pairs (at most ``FREQUENT`` of them, whatever the
   corpus) are looked up in the tasks; all other pairs, of which there are few rows each by
   choice, are joined.  So no pair is a hot key, and nothing is left out.

Defined cases: a text that is null, empty or not rebuilt exactly by the tokens of both has
no tokens: zeros and an empty ``groups``; repeated rows count as documents of their own; a
null doc_id is kept; an empty table gives an empty result; other columns are ignored.
Special tokens' strings in a text are plain text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.llm.common import read_table, trimmed, workspace, written

FREQUENT = 1 << 19
BLOCK_BYTES = 1 << 18
COUNTED = 1 << 21  # id pairs that a task gathers before it adds them up

# The splitting pattern of byte-level BPE (fixed value)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "pairs array<long>, uses array<int>")
SUMMED = ("doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "n_best long, count_sum long, rest array<long>, rest_uses array<int>")


def byte_of_sign() -> dict[str, int]:
    """The printable sign that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Byte-level BPE of a tokenizer file: ids and the bytes of every id.

    The merges run in a faster library where the ids stand in the order of the merges (so
    that an id is its own rank), and for any other file or failure in the file's own one.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            known = json.load(f)
        signs = byte_of_sign()
        self.bytes = [b""] * (1 + max(known["model"]["vocab"].values()))
        for entry, i in known["model"]["vocab"].items():
            self.bytes[i] = bytes(signs[c] for c in entry) if all(c in signs for c in entry) else entry.encode()
        specials = [t["id"] for t in known["added_tokens"]]
        self.bytes += [b""] * (1 + max([len(self.bytes) - 1, *specials]) - len(self.bytes))
        self.slow = self.fast = None
        split, model = known["pre_tokenizer"] or {}, known["model"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"].get(a + b, -1) for a, b in pairs]
        plain = known["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") \
            and not split.get("add_prefix_space") and not model.get("ignore_merges") and not model.get("dropout")
        if plain and made == list(range(256, 256 + len(made))):
            import tiktoken

            ranks = {self.bytes[i]: i for i in model["vocab"].values() if i not in specials}
            self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast:
            try:
                return [self.fast.encode_ordinary(t) for t in texts]
            except BaseException as e:  # the regex engine gives up on some very long runs of signs
                if type(e).__name__ not in ("PanicException", "ValueError"):
                    raise
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
            self.slow.encode_special_tokens = True
        return [e.ids for e in self.slow.encode_batch_fast(texts, add_special_tokens=False)]


class PieceModel:
    """A piece model with byte fallback: ids and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(self.model.id_to_piece(i)[1:-1], 16)]) if self.model.is_byte(i)
                      else self.model.id_to_piece(i).replace("▁", " ").encode()
                      for i in range(self.model.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Label of every token (those of A, then those of B): the index of its group's last token of B."""
    n = len(ends_a)
    successor = np.empty(n + len(ends_b), np.int64)
    successor[:n] = n + np.searchsorted(ends_b, ends_a)
    over = np.searchsorted(ends_a, ends_b)
    successor[n:] = np.where(ends_a[over] == ends_b, np.arange(n, len(successor)), over)
    while True:
        onward = successor[successor]
        if np.array_equal(onward, successor):
            return successor
        successor = onward


class Aligner:
    """Groups, links and id pairs of blocks of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), PieceModel(path_b)
        self.entries = [pa.array(x.bytes, pa.binary()) for x in (self.a, self.b)]
        self.lengths = [np.fromiter(map(len, x.bytes), np.int64, len(x.bytes)) for x in (self.a, self.b)]
        most = max(len(self.a.bytes), len(self.b.bytes))
        self.written = pa.array([f"{i}{s}" for i in range(most) for s in ",|;"], pa.binary())

    @property
    def span(self) -> int:
        """An id pair is the id of A times this, plus the id of B."""
        return len(self.b.bytes)

    def _exact(self, side: int, ids: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> list[bool]:
        """Do the tokens' bytes make up the text?"""
        joined = self.entries[side].take(pa.array(ids))
        raw = memoryview(joined.buffers()[2] or b"").cast("B")
        ends = np.concatenate(([0], np.cumsum(self.lengths[side][ids])))[np.concatenate(([0], np.cumsum(counts)))]
        return [raw[s:e] == t for s, e, t in zip(ends[:-1].tolist(), ends[1:].tolist(), texts, strict=True)]

    def block(self, texts: list[str | None]) -> dict[str, pa.Array]:
        """Columns of ``ALIGNED`` but doc_id."""
        some = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in some]
        raw = [t.encode() for t in spaced]
        lists = [self.a.encode(spaced), self.b.encode([texts[i] for i in some])]
        ids, counts = [], []
        good = np.ones(len(some), bool)
        for side, found in enumerate(lists):
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.int64, int(counts[side].sum())))
            good &= np.array(self._exact(side, ids[side], counts[side], raw), bool)
        for side in (0, 1):
            ids[side] = ids[side][np.repeat(good, counts[side])]
            counts[side] = np.where(good, counts[side], 0)
        return self._columns(len(texts), np.array(some, np.int64), *ids, *counts)

    def _columns(self, n: int, some: np.ndarray, a: np.ndarray, b: np.ndarray,
                 count_a: np.ndarray, count_b: np.ndarray) -> dict[str, pa.Array]:
        ends_a, ends_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        owner_a, owner_b = np.repeat(some, count_a), np.repeat(some, count_b)
        label = terminals(ends_a, ends_b) if len(a) else np.zeros(0, np.int64)
        last = np.flatnonzero(label == np.arange(len(label)))
        group = np.searchsorted(last, label)
        # tokens by group, A before B; the sign after each: "," "|" or ";"
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(group * 2 + side, kind="stable")
        g, s = group[order], side[order]
        sign = np.full(len(order), 2)
        sign[:-1] = np.where(g[1:] != g[:-1], 2, s[1:] - s[:-1])
        shown = self.written.take(pa.array(np.concatenate((a, b))[order] * 3 + sign))
        raw = memoryview(shown.buffers()[2] or b"").cast("B")
        upto = np.frombuffer(shown.buffers()[1], np.int32)[:len(shown) + 1] if len(shown) else np.zeros(1, np.int32)
        tokens = np.zeros(n, np.int64)
        tokens[some] = count_a + count_b
        cuts = upto[np.concatenate(([0], np.cumsum(tokens)))].tolist()
        groups = [bytes(raw[x:max(x, y - 1)]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        # one link per stretch between neighbouring ends
        stops = np.sort(np.concatenate((ends_a, ends_b)), kind="stable")
        stops = stops[np.diff(stops, append=-1) != 0]
        at_a, at_b = np.searchsorted(ends_a, stops), np.searchsorted(ends_b, stops)
        owner = owner_a[at_a]
        every = len(self.a.bytes) * self.span
        pair, uses = np.unique(owner * every + a[at_a] * self.span + b[at_b], return_counts=True)
        offsets = pa.array(np.searchsorted(pair, np.arange(n + 1) * every).astype(np.int32))
        per_text = {"n_a": owner_a, "n_b": owner_b, "n_groups": owner_b[last - len(a)], "n_links": owner}
        return {**{c: pa.array(np.bincount(o, minlength=n), pa.int64()) for c, o in per_text.items()},
                "groups": pa.array(groups, pa.binary()).cast(pa.string()),
                "pairs": pa.ListArray.from_arrays(offsets, pa.array(pair % every)),
                "uses": pa.ListArray.from_arrays(offsets, pa.array(uses.astype(np.int32)))}


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Groups and id pairs (with the number of their links) of every row (schema ``ALIGNED``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(path_a, path_b)
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes.astype(np.int64)) // BLOCK_BYTES)) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                part = batch.slice(x, y - x)
                found = aligner.block(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *found.values()], ["doc_id", *found])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")) \
        .mapInArrow(trimmed(run), ALIGNED)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per id pair of a task's rows (pair, n); a task with very many pairs gives some
    of them more than once."""

    def added(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(codes, kind="stable")
        codes, n = codes[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        return codes[first], np.add.reduceat(n, first)

    def batch_of(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["pair", "n"])

    codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh: list[np.ndarray] = []
    size = 0
    for batch in batches:
        fresh.append(batch.column("pairs").flatten().to_numpy().copy())
        size += len(fresh[-1])
        if size >= COUNTED:
            codes, n = added(np.concatenate((codes, *fresh)), np.concatenate((n, np.ones(size, np.int64))))
            fresh, size = [], 0
            if len(codes) >= COUNTED:
                yield batch_of(codes, n)
                codes, n = codes[:0], n[:0]
    if size + len(codes):
        yield batch_of(*added(np.concatenate((codes, *fresh)), np.concatenate((n, np.ones(size, np.int64)))))


def looked_up(pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) \
        -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """n_best and count_sum over the given (sorted) pairs, and the rest of each row's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some, uses = (batch.column(c) for c in ("pairs", "uses"))
            ends = np.concatenate(([0], np.cumsum(pc.list_value_length(some).to_numpy(zero_copy_only=False)))) \
                .astype(np.int64)
            code, n = some.flatten().to_numpy(), uses.flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(pairs, code), max(0, len(pairs) - 1))
            hit = pairs[at] == code if len(pairs) else np.zeros(len(code), bool)
            at = at[hit]
            sums = []
            for value in (best[at].astype(np.int64), counts[at]):
                each = np.zeros(len(code), np.int64)
                each[hit] = value * n[hit]
                upto = np.concatenate(([0], np.cumsum(each)))
                sums.append(pa.array(upto[ends[1:]] - upto[ends[:-1]]))
            offsets = pa.array(np.concatenate(([0], np.cumsum(~hit)))[ends].astype(np.int32))
            rest = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (code[~hit], n[~hit].astype(np.int32))]
            kept = [c for c in batch.schema.names if c not in ("pairs", "uses")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *sums, *rest],
                                             [*kept, "n_best", "count_sum", "rest", "rest_uses"])

    return run


def align(docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    ``n_best``: links whose id pair has the most documents of all pairs of its id of A;
    ``count_sum``: documents of the id pair, summed over the links.
    """
    span = len(PieceModel(path_b).bytes)
    with workspace(docs.sparkSession, "alignment") as write:
        whole = write(alignments(docs, path_a, path_b).select(
            "doc_id", F.monotonically_increasing_id().alias("row"), "n_a", "n_b", "n_groups", "n_links",
            F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit("")).alias("groups_sha256"),
            "pairs", "uses"), "aligned")
        total = whole.select("pairs").mapInArrow(trimmed(counted), "pair long, n long") \
            .groupBy("pair").agg(F.sum("n").alias("n"))
        first = F.expr(f"pair div {span}")
        numbers = write(total, "pair-documents")
        top = numbers.groupBy(first.alias("a")).agg(F.max("n").alias("most"))  # a row per id of A at most
        counts = write(numbers.withColumn("a", first).join(top, "a")
                       .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")
        # the least power of two that at most ``frequent`` pairs reach
        level = {r[0]: r[1] for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k"))
                 .agg(F.count(F.lit(1))).collect()}  # at most 63 rows
        k = max(level, default=0) + 1
        while k > 0 and sum(n for j, n in level.items() if j >= k - 1) <= frequent:
            k -= 1
        common = counts.where(F.col("n") >= 1 << k).orderBy("pair").toArrow()  # at most ``frequent`` rows
        known = [common[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")]
        summed = write(whole.mapInArrow(trimmed(looked_up(*known)), SUMMED), "summed")
        plain = [c for c in summed.columns if not c.startswith("rest")]
        others = summed.where(F.size("rest") > 0)
        spread = others.select("row", F.explode(F.arrays_zip("rest", "rest_uses")).alias("r")) \
            .select("row", F.col("r.rest").alias("pair"), F.col("r.rest_uses").cast("long").alias("uses"))
        more = spread.join(counts.where(F.col("n") < 1 << k), "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("uses")).otherwise(0)).alias("_best"),
            F.sum(F.col("n") * F.col("uses")).alias("_sum"))
        joined = others.select(*plain).join(more, "row") \
            .withColumn("n_best", F.col("n_best") + F.col("_best")) \
            .withColumn("count_sum", F.col("count_sum") + F.col("_sum")).select(*plain)
        return written(summed.where(F.size("rest") == 0).select(*plain).unionByName(joined).select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), "alignment")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of a byte-level and a piece vocabulary over every document."""
    import public_tokenizers

    return align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))
