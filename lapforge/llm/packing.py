"""Hierarchical multi-length packing (operator 1).

Documents are tokenised and packed in one pass over the scan's partitions: no
shuffle and no stored token ids, so a hot source or a huge group of copies is
just more rows of more partitions.  In a partition:

1. full windows of the longest tier are cut off the front of a long document;
2. the rest is routed to the smallest tier (512, 1024, 2048, 4096) that holds it;
3. pools of at most ``POOL_TOKENS`` tokens are packed tier by tier, longest first:
   every document opens a window of its tier, and the gap is filled with whole
   documents of shorter tiers (best fit), the last of them cut to fit exactly;
   the shortest tier is filled the same way from itself;
4. what cannot fill a window waits for the next pool; at the end of the partition
   it is cut into windows of falling powers of two.

Every sequence is therefore exactly a power of two long and needs no padding.
Sequences of one window length are grouped into steps of ``STEP_TOKENS`` tokens,
so each step costs the same number of tokens whatever its tier.

Defined cases: a null or empty text is one token (the end id); a null doc_id is
kept; repeated rows are packed once each; an empty table gives no pieces; other
columns are ignored.  A retried task repeats its partition, so ids are stable.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from lapforge.llm.common import read_table, text_of, trimmed
from lapforge.llm.words import SPACES, Hasher, blocks

TIERS = (512, 1024, 2048, 4096)
END_ID = 2
POOL_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
WHOLE_PIECES = 8  # after so many whole pieces a window's gap is filled by a cut
CACHE_WORDS = 1_000_000
BATCH_ROWS = 1000

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, window long, step_group long")


class Encoder:
    """Token ids as little-endian uint32 bytes.

    A word's ids do not depend on its neighbours, so texts of plain Latin
    characters are cut into the tokenizer's words (runs of letters, single digits,
    runs of other signs) all at once; only a word not seen before in the task is
    run through the vocabulary's merges.  Any other text goes through the tokenizer
    whole: other scripts, a special token's string, an apostrophe that may begin a
    contraction.
    """

    # characters for which lower-casing and composition are one to one
    PLAIN = re.compile("[\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u0148\u014a-\u017e]*")
    SPECIAL = re.compile("<\\||'[stmdrvlSTMDRVL]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        # byte-level vocabularies write printable bytes as themselves, the rest from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(256 + i) for i, b in enumerate(hidden) if b != 10}
        self.hasher = Hasher(SPACES)
        self.kind = np.full(256, 3, np.uint8)  # signs
        self.kind[list(b"\t\n\r ")] = 0
        self.kind[[b for b in range(256) if b >= 128 or chr(b).isalpha()]] = 1
        self.kind[48:58] = 2
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes of the words seen, sorted
        self.number = np.zeros(0, np.int64)  # their numbers
        self.first = array("q")  # number -> where its ids begin
        self.count = array("q")
        self.ids = array("I")

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        """New words (sorted by their hash)."""
        text = b"\n".join(words).decode().lower().encode().decode("latin-1").translate(self.letters)
        numbers = np.arange(len(self.first), len(self.first) + len(words))
        merge, ids, number_of = self.merge, self.ids, attrgetter("id")
        for word in text.split("\n"):
            tokens = merge(word)
            self.first.append(len(ids))
            self.count.append(len(tokens))
            ids.extend(map(number_of, tokens))
        at = np.searchsorted(self.known, keys)
        self.known = np.insert(self.known, at, keys)
        self.number = np.insert(self.number, at, numbers)

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        raw = b" ".join(texts) + b" "
        data = np.frombuffer(raw, np.uint8)
        kind = self.kind[data]
        edge = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == 2)))
        starts = np.flatnonzero(edge)
        ends = np.append(starts[1:], len(data))
        word = kind[starts] != 0
        starts, ends = starts[word], ends[word]
        keys, at, which = np.unique(self.hasher.spans(data, starts, ends), return_index=True,
                                    return_inverse=True)
        if len(self.known) > CACHE_WORDS:
            self._forget()
        new = np.flatnonzero(~np.isin(keys, self.known, assume_unique=True))
        if len(new):
            self._learn(keys[new], [raw[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())])
        number = self.number[np.searchsorted(self.known, keys)][which]
        first, count = np.frombuffer(self.first, np.int64)[number], np.frombuffer(self.count, np.int64)[number]
        done = np.cumsum(count)
        flat = np.frombuffer(self.ids, np.uint32)[
            np.repeat(first - (done - count), count) + np.arange(done[-1] if len(done) else 0)]
        # tokens up to the end of each text
        words_to = np.searchsorted(starts, np.cumsum(lengths))
        tokens_to = np.concatenate(([0], done))[words_to].tolist()
        return [flat[a:b].tobytes() for a, b in zip([0, *tokens_to], tokens_to)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if self.PLAIN.fullmatch(t) and not self.SPECIAL.search(t):
                plain.append((i, t.encode()))
            else:
                ids = self.tokenizer.encode(t, add_special_tokens=False).ids
                out[i] = np.array(ids, np.uint32).tobytes()
        for first, block in blocks([t for _, t in plain]):
            for (i, _), ids in zip(plain[first:], self._plain(block)):
                out[i] = ids
        return out


class Packer:
    """Packs one partition's documents; ``rows`` holds finished pieces."""

    def __init__(self, partition: int, tiers: tuple[int, ...] = TIERS, pool: int = POOL_TOKENS):
        self.tiers, self.pool = tiers, pool
        self.waiting: list[tuple[int, int, tuple]] = []  # sorted by length: (length, no, item)
        self.tokens, self.no = 0, 0
        self.base, self.sequences = partition << 40, 0
        self.steps: dict[int, list[int]] = {}
        self.step_no = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """A document's ids (uint32 bytes) with its end id."""
        total, top, start = len(ids) // 4, self.tiers[-1], 0
        while total - start >= top:
            self._emit(top, [(doc_id, start, ids[4 * start:4 * (start + top)], total)])
            start += top
        if total > start:
            self._wait((doc_id, start, ids[4 * start:], total))
        if self.tokens >= self.pool:
            self._pack()

    def _wait(self, item: tuple) -> None:
        n = len(item[2]) // 4
        self.no += 1
        insort(self.waiting, (n, self.no, item))
        self.tokens += n

    def _take(self, i: int) -> tuple:
        n, _, item = self.waiting.pop(i)
        self.tokens -= n
        return item

    def _cut(self, item: tuple, n: int) -> tuple:
        """The first ``n`` tokens of an item; the rest waits again."""
        doc_id, start, ids, total = item
        if len(ids) > 4 * n:
            self._wait((doc_id, start + n, ids[4 * n:], total))
        return doc_id, start, ids[:4 * n], total

    def _fill(self, window: int, pieces: list[tuple]) -> None:
        """Fill ``window`` from the waiting items; they must hold enough tokens."""
        gap = window - sum(len(p[2]) // 4 for p in pieces)
        while gap:
            i = bisect_right(self.waiting, (gap, float("inf"))) - 1  # the longest that fits
            fits = i >= 0 and (self.waiting[i][0] == gap or len(pieces) < WHOLE_PIECES)
            item = self._cut(self._take(i if fits else min(i + 1, len(self.waiting) - 1)), gap)
            pieces.append(item)
            gap -= len(item[2]) // 4
        self._emit(window, pieces)

    def _pack(self) -> None:
        """Pack while enough tokens wait to fill any window that is opened."""
        while self.tokens >= 2 * self.tiers[-1]:
            item = self._take(len(self.waiting) - 1)  # the longest opens a window of its tier
            n = len(item[2]) // 4
            window = next(t for t in self.tiers if t >= n)
            self._fill(window, [item])

    def _emit(self, window: int, pieces: list[tuple]) -> None:
        step = self.steps.get(window)
        if step is None or step[1] + window > STEP_TOKENS:
            step = self.steps[window] = [self.base + self.step_no, 0]
            self.step_no += 1
        step[1] += window
        offset, sequence = 0, self.base + self.sequences
        self.sequences += 1
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, sequence, offset, window, step[0]))
            offset += n

    def close(self) -> None:
        """The partition's tail: windows of falling powers of two, all full."""
        self._pack()
        while self.tokens:
            self._fill(min(self.tiers[-1], 1 << (self.tokens.bit_length() - 1)), [])


def pack(docs: DataFrame, vocabulary: str, tiers: tuple[int, ...] = TIERS,
         pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """One row per piece of a document (schema ``SCHEMA``).

    ``vocabulary`` is the path of a tokenizer file that every executor can read;
    ``tiers`` are powers of two.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers must be rising powers of two")
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        packer = Packer(TaskContext.get().partitionId(), tiers, pool_tokens)
        end = END_ID.to_bytes(4, "little")

        def done() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True))
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            for k in range(0, batch.num_rows, BATCH_ROWS):
                rows = batch.slice(k, BATCH_ROWS)
                for doc_id, ids in zip(rows.column(0).to_pylist(),
                                       encoder.encode(rows.column(1).to_pylist()), strict=True):
                    packer.add(doc_id, ids + end)
                if packer.rows:
                    yield done()
        packer.close()
        if packer.rows:
            yield done()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")) \
        .mapInArrow(trimmed(run), SCHEMA)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed with the public word vocabulary."""
    import public_tokenizers

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
