"""Language ID by cross-parsing entropy (operator 9).

A suffix automaton is built per language from a bounded sample of labelled text.
A text is parsed from left to right into the longest phrases that occur in the
language's sample; with ``c`` phrases over ``n`` characters and ``N`` sample
characters its entropy under the language is ``c * log2(N) / n``.  The language
with the least entropy wins.

Every letter of the samples has a code of its own (0 is any non-letter, 1 any letter
that no sample has).  Each automaton becomes one table ``state x character -> state``;
a missing transition holds the state that starts the next phrase and is marked as a
break.  Where the samples have more than ``ALPHABET`` letters, a language's table has
columns for the most frequent ones of its own sample, and the transitions of its other
letters are one sorted list.
Texts are parsed side by side, one character of every text per step; texts are
cut into segments of ``SEGMENT`` characters for that (a cut is a phrase end), and
every segment of the whole text counts.

Sample bound: about ``SAMPLE_DOCS`` labelled documents per language, one slice of
``SLICE`` characters each (longer ones where there are fewer documents), at most
``SAMPLE_CHARS`` characters.

Defined cases: a null text or one without a letter is ``und`` with score 0; ties
go to the language that sorts first; null languages are not learned from; with no
labelled text every document is ``und``; repeated rows are scored alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.llm.common import fold, hash_sample, read_table, trimmed, value_counts

FOLDS, HELD_OUT = 4, 2
SAMPLE_DOCS = 400
SLICE = 200
SAMPLE_CHARS = 20_000
SEGMENT = 2048
BATCH_CHARS = 1_000_000
ALPHABET = 62  # letters with a column in the tables; other letters of a sample have sparse transitions
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def samples(docs: DataFrame) -> dict[str, str]:
    """Language -> its sample text, from labelled rows outside the held-out fold."""
    rows = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
        & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    counts = value_counts(rows, "lang")
    size = F.lit(SLICE)
    for lang, n in counts.items():  # longer slices where there are few documents
        if n < SAMPLE_DOCS:
            size = F.when(F.col("lang") == lang, F.lit(max(SLICE, -(-SAMPLE_CHARS // n)))).otherwise(size)
    room = F.greatest(F.length("text") - size, F.lit(0)) + F.lit(1)
    start = F.pmod(F.xxhash64(F.lit(5), F.col("doc_id")), room.cast("long")).cast("int") + F.lit(1)
    picked = hash_sample(rows, "doc_id", SAMPLE_DOCS, by="lang", counts=counts).select(
        "lang", F.xxhash64(F.lit(17), F.col("doc_id")).alias("h"),
        F.substring(F.col("text"), start, size).alias("slice"))
    out: dict[str, str] = {}
    for lang, _, piece in sorted(map(tuple, picked.collect())):
        text = out.get(lang, "")
        if len(text) < SAMPLE_CHARS:
            out[lang] = text + piece[:SAMPLE_CHARS - len(text)] + " "
    return {k: v for k, v in out.items() if any(c.isalpha() for c in v)}


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return nxt


class CrossParser:
    """Counts phrases of many texts under every language."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        counts: dict[str, int] = {}
        for t in texts.values():
            for c in t.lower():
                if c.isalpha():
                    counts[c] = counts.get(c, 0) + 1
        letters = sorted(sorted(counts), key=lambda c: -counts[c])
        self.size = len(letters) + 2
        self.type = np.min_scalar_type(self.size)
        self.codes = np.fromiter((chr(i).isalpha() for i in range(0x110000)), self.type, 0x110000)
        for upper in (True, False):  # of letters with one upper case the most frequent has it
            for i, c in reversed(list(enumerate(letters))):
                form = c.upper() if upper else c
                if len(form) == 1:
                    self.codes[ord(form)] = i + 2
        self.tables, self.bits, self.columns, self.rare = [], [], [], []
        for lang in self.languages:
            sample = self.encode(texts[lang])
            self.bits.append(np.log2(max(2, len(sample))))
            columns = self._columns(sample)
            table, rare = self._table(automaton(sample.tolist()), columns)
            self.tables.append(table)
            self.columns.append(columns)
            self.rare.append(rare)

    def _columns(self, sample: np.ndarray) -> np.ndarray | None:
        """Code -> column of a language's table (1 for a letter without one); None: the code itself."""
        if self.size <= ALPHABET + 2:
            return None
        shown = np.bincount(sample, minlength=self.size)
        shown[:2] = 0
        dense = np.argsort(-shown, kind="stable")[:ALPHABET]
        dense = dense[shown[dense] > 0]
        columns = np.ones(self.size, np.uint8)
        columns[0] = 0
        columns[dense] = np.arange(2, len(dense) + 2)
        return columns

    def encode(self, text: str) -> np.ndarray:
        """Character codes; runs of non-letters become one."""
        x = self.codes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
        return x[keep]

    def _table(self, states: list[dict[int, int]], columns: np.ndarray | None) -> tuple:
        """(dense table, transitions of letters without a column or None).

        The latter are (keys state * size + code, in order; their states; code -> is it such a
        letter; code -> the marked state that starts the next phrase; the table's width).
        """
        column = list(range(self.size)) if columns is None else columns.tolist()
        width = max(column) + 1
        start = np.zeros(width, np.int32)
        begin = np.full(self.size, -1, np.int32)
        for c, s in states[0].items():
            begin[c] = ~(s * width)
            if column[c] != 1 or columns is None:
                start[column[c]] = s * width
        table = np.tile(~start, (len(states), 1))
        rare = []
        for k, (row, arcs) in enumerate(zip(table, states, strict=True)):
            for c, s in arcs.items():
                if column[c] != 1 or columns is None:
                    row[column[c]] = s * width
                else:
                    rare.append((k * self.size + c, s * width))
        if not rare:
            return table.ravel(), None
        keys, to = np.array(sorted(rare), np.int64).T
        special = np.zeros(self.size, bool)
        special[[c for c in states[0] if column[c] == 1]] = True
        return table.ravel(), (keys.copy(), to.astype(np.int32), special, begin, width)

    def _rare_step(self, rare: tuple, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The table's answer for letters without a column."""
        keys, to, _, begin, width = rare
        key = state.astype(np.int64) // width * self.size + code
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, to[at], begin[code])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """[text, language]: phrases; 0 for an empty text."""
        segments = [(i, t[k:k + SEGMENT]) for i, t in enumerate(texts) for k in range(0, len(t), SEGMENT)]
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        if not segments:
            return out
        segments.sort(key=lambda s: -len(s[1]))
        lengths = np.array([len(s) for _, s in segments])
        grid = np.zeros((len(segments), lengths[0]), self.type)
        for row, (_, s) in zip(grid, segments, strict=True):
            row[:len(s)] = s
        grid = np.ascontiguousarray(grid.T)
        active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
        owner = np.array([i for i, _ in segments])
        for k, (table, columns, rare) in enumerate(zip(self.tables, self.columns, self.rare, strict=True)):
            state = np.zeros(len(segments), np.int32)
            breaks = np.zeros(len(segments), np.int32)
            place = grid if columns is None else columns[grid]
            for t, n in enumerate(active):
                s = table[state[:n] + place[t, :n]]
                if rare:
                    at = np.flatnonzero(rare[2][grid[t, :n]])
                    s[at] = self._rare_step(rare, state[at], grid[t, at])
                broken = s >> 31
                breaks[:n] -= broken
                np.bitwise_xor(s, broken, out=state[:n])
            np.add.at(out[:, k], owner, breaks + 1)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        encoded = [self.encode(t or "") for t in texts]
        letters = np.array([bool(x.any()) for x in encoded], bool)
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        count = np.array([len(x) for x in encoded])
        entropy = self.phrases(encoded) * np.array(self.bits) / np.maximum(count, 1)[:, None]
        best = entropy.argmin(axis=1)
        least = entropy.min(axis=1)
        rest = entropy.copy()
        rest[np.arange(len(texts)), best] = np.inf
        second = rest.min(axis=1)
        score = np.where(np.isfinite(second), 1 - least / np.maximum(second, 1e-12), 1.0)
        langs = [self.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
        return langs, np.where(letters, np.clip(score, 0, 1), 0.0).tolist()


def predicted(batches: Iterator[pa.RecordBatch], texts: dict[str, str],
              text_of_rows: Callable[[pa.RecordBatch], pa.Array]) -> Iterator[tuple]:
    """(rows, languages, scores) of batches with a column n, the characters of each text."""
    parser = CrossParser(texts)
    for batch in batches:
        lengths = np.cumsum(batch.column("n").to_numpy())
        cuts = np.flatnonzero(np.diff(lengths // BATCH_CHARS)) + 1
        for part in np.split(np.arange(batch.num_rows), cuts):
            if len(part):
                rows = batch.slice(part[0], len(part))
                yield rows, *parser.predict(text_of_rows(rows).to_pylist())


def identify(docs: DataFrame, texts: dict[str, str]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, langs, scores in predicted(batches, texts, lambda rows: rows.column("text")):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("held_out"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"), "text") \
        .mapInArrow(trimmed(run), RESULT)


def with_language(docs: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``docs`` with the prediction as ``lang``, without the documents that are ``und``.

    Where no language was learned at all, documents with a letter stay as they are.
    """
    if not texts:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    columns = docs.columns
    at, text_at = columns.index("lang"), columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, langs, _ in predicted(batches, texts, lambda rows: rows.column("row").field(text_at)):
            held = rows.column("row").flatten()
            held[at] = pa.array(langs, pa.string())
            keep = pa.array([x != "und" for x in langs], pa.bool_())
            yield pa.RecordBatch.from_arrays(held, columns).filter(keep)

    schema = docs.schema
    return docs.select(F.struct(*columns).alias("row"),
                       F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n")).mapInArrow(trimmed(run), schema)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, samples(docs))
