"""Periodic run detection with string synchronising sets (operator 13).

A run is a stretch of words with smallest period q and at least ``EXPONENT`` times q
words that no neighbouring word extends keeping the period.  Runs are found by numpy
over blocks of whole texts (words are 64-bit hashes, every text ends with a word of its
own, so nothing crosses a border):

1. Highly periodic regions of the small periods 1 and 2 are found by comparing the words
   with those 1 and 2 places on.
2. For the dyadic scales tau = 1, 2, 4, .. the synchronising set is taken: a position i is
   in it when the least hash of the tau-word pieces that start in i .. i + tau stands at
   either end of that range.  Pieces of period tau / 3 or less take no part; they lie in
   the runs that smaller scales have found.  Whether i is chosen depends on the 2 tau
   words after it only, and a range of tau positions without any lies in a highly periodic
   region.
3. Chosen positions with the same 2 tau words, 3 tau <= p < 6 tau places apart, propose the
   period p.  A run of period p and at least 3 p words holds such a pair within its first
   period, as its first 2 p words would else have a smaller period; and there the p words
   at the first position equal the next p.  One comparison of hashes thus drops chance
   pairs.  Equal contexts lie more than tau / 3 apart, so a position has at most 18
   partners.
4. Every proposal is extended to both sides on the words themselves; a stretch found with
   several periods has the smallest of them.

The scans are dealt by Spark; texts never meet each other, so no key is hot and nothing is
shuffled.

Defined cases: null text has no words and stays null in ``collapsed``; empty text or text
without words has no runs and an empty ``collapsed``; repeated rows each get their result;
a null doc_id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lapforge.llm.common import read_table, release, trimmed
from lapforge.llm.words import SPACES, Hasher, mix

EXPONENT = 3
LEAST_WORDS = 24
BLOCK_BYTES = 1 << 18
BASE = np.uint64(0xD1342543DE82EF95)  # odd: hashes of pieces are polynomials in it modulo 2^64
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)

RUNS = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
        "best struct<start:long,length:long,period:long>, collapsed string")


class Pieces:
    """Hashes of pieces of a sequence, by prefix sums of a polynomial."""

    def __init__(self, t: np.ndarray):
        n = len(t)
        first = np.full(n + 1, BASE, np.uint64)
        first[0] = 1
        up = np.multiply.accumulate(first)
        first[1:] = np.uint64(pow(int(BASE), -1, 1 << 64))
        self.down = np.multiply.accumulate(first)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(t * up[:n], out=self.total[1:])

    def at(self, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return (self.total[starts + length] - self.total[starts]) * self.down[starts]

    def all(self, length: int) -> np.ndarray:
        """Of every piece of ``length`` words, by place."""
        last = len(self.total) - length
        return (self.total[length:] - self.total[:last]) * self.down[:last]


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of x[i:i + width] for every i of x (cut at the end)."""
    n = len(x)
    padded = np.full(-(-(n + width) // width) * width, NEVER, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:n + width - 1])


def stretch(t: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """The longest [s, e) around i .. i + p - 1 in which words p apart are the same."""

    def same(x: np.ndarray, y: np.ndarray) -> int:
        """Length of the common prefix."""
        differ = np.flatnonzero(x != y)
        return int(differ[0]) if len(differ) else len(x)

    e, step = i, max(64, p)
    while e + p < len(t):
        size = min(step, len(t) - p - e)
        k = same(t[e:e + size], t[e + p:e + p + size])
        e, step = e + k, 2 * step
        if k < size:
            break
    s, step = i, max(64, p)
    while s > 0:
        size = min(step, s)
        k = same(t[s - size:s][::-1], t[s - size + p:s + p][::-1])
        s, step = s - k, 2 * step
        if k < size:
            break
    return s, e + p


def small_periods(t: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the stretches of at least 3 p words in which words p apart are the same."""
    same = np.concatenate(([False], t[:-p] == t[p:], [False])) if len(t) > p else np.zeros(2, bool)
    edge = np.flatnonzero(same[1:] != same[:-1])
    s, e = edge[0::2], edge[1::2] + p
    long = e - s >= EXPONENT * p
    return s[long], e[long]


def runs_in(t: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, periods) of all runs, by start and period, of a sequence of texts.

    ``longest``: words of the longest text.  Runs of fewer than ``LEAST_WORDS`` words are
    in it as well.
    """
    found: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period
    for p in (1, 2):
        for s, e in zip(*(x.tolist() for x in small_periods(t, p)), strict=True):
            found.setdefault((s, e), p)
    pieces = Pieces(t)
    tau = 1
    while 9 * tau <= longest:
        for i, p in proposals(t, pieces, tau, found):
            s, e = stretch(t, i, p)
            if e - s >= EXPONENT * p:
                found[s, e] = min(p, found.get((s, e), p))
        tau *= 2
    rows = np.array(sorted((s, e - s, p) for (s, e), p in found.items()), np.int64).reshape(-1, 3)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return rows[:, 0], rows[:, 1], rows[:, 2]


def proposals(t: np.ndarray, pieces: Pieces, tau: int, found: dict[tuple[int, int], int]) -> Iterator[tuple[int, int]]:
    """(i, p): a position and a period of 3 tau to 6 tau - 1 with t[i:i + p] like t[i + p:i + 2 p].

    One proposal of a period per stretch is enough, so those inside the last one are left out.
    """
    n = len(t)
    if n < 3 * tau:
        return
    key = mix(pieces.all(tau), tau.bit_length())
    for (s, e), p in found.items():
        if 3 * p <= tau <= e - s:
            key[s:e - tau + 1] = NEVER
    least = sliding_least(key, tau + 1)[:n - 2 * tau + 1]
    chosen = np.flatnonzero((least != NEVER) & ((least == key[:len(least)]) | (least == key[tau:tau + len(least)])))
    context = pieces.at(chosen, 2 * tau)
    order = np.lexsort((chosen, context))
    at, context = chosen[order], context[order]
    one, apart = [], []
    k = 1
    while k < len(at):
        gap = at[k:] - at[:-k]
        near = (context[k:] == context[:-k]) & (gap < 6 * tau)
        if not near.any():
            break
        wide = np.flatnonzero(near & (gap >= 3 * tau))
        one.append(at[wide])
        apart.append(gap[wide])
        k += 1
    if not one:
        return
    i, p = np.concatenate(one), np.concatenate(apart)
    inside = i + 2 * p <= n
    i, p = i[inside], p[inside]
    square = pieces.at(i, p) == pieces.at(i + p, p)
    i, p = i[square], p[square]
    order = np.lexsort((i, p))
    last, until = 0, -1
    for x, q in zip(i[order].tolist(), p[order].tolist(), strict=True):
        if q != last or x + q >= until:
            last, until = q, stretch(t, x, q)[1]
            yield x, q


class Finder:
    """Runs and collapsed texts of blocks of texts."""

    def __init__(self, least_words: int):
        self.hasher, self.least = Hasher(SPACES), least_words

    def block(self, texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
        """(words, runs, collapsed text) of every text."""
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        inside = self.hasher.inside[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).view(np.int8)))
        starts, ends = edge[0::2], edge[1::2]
        limits = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        owner = np.searchsorted(limits, starts, side="right")
        n_words = np.bincount(owner, minlength=len(texts))
        first = np.cumsum(n_words) - n_words
        # every text is followed by a word that stands nowhere else
        t = np.zeros(len(starts) + len(texts), np.uint64)
        place = np.arange(len(starts)) + owner
        t[place] = self.hasher.spans(data, starts, ends)
        t[first + n_words + np.arange(len(texts))] = mix(np.arange(len(texts), dtype=np.uint64), 77)
        s, length, period = runs_in(t, int(n_words.max(initial=0)))
        ok = length >= self.least
        s, length, period = s[ok], length[ok], period[ok]
        text_of_run = np.searchsorted(first + np.arange(len(texts)), s, side="right") - 1
        kept = np.ones(len(t), bool)
        for a, n, q in zip(s.tolist(), length.tolist(), period.tolist(), strict=True):
            kept[a + q:a + n] = False
        # the bytes of kept words and the one after each, which becomes a space
        step = np.zeros(len(data) + 1, np.int8)
        stays = kept[place]
        step[starts[stays]] = 1
        step[ends[stays] + 1] -= 1
        taken = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        spaced = np.where(inside, data, np.uint8(32))
        upto = np.concatenate(([0], np.cumsum(taken)))
        whole = spaced[taken].tobytes()
        runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, a, n, q in zip(text_of_run.tolist(), s.tolist(), length.tolist(), period.tolist(), strict=True):
            runs[k].append((a - int(first[k]) - k, n, q))
        for k in range(len(texts)):
            a, b = upto[limits[k - 1] if k else 0], upto[limits[k]]
            yield int(n_words[k]), runs[k], whole[a:max(a, b - 1)]


def best_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Run of the greatest length / period, then the smallest start and period."""
    best = None
    for run in runs:  # by start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), best and collapsed (words joined by one
    space; of every run only the first period) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(least_words)
        triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

        def struct(r: tuple[int, int, int]) -> dict[str, int]:
            return {"start": r[0], "length": r[1], "period": r[2]}

        for batch in batches:
            sizes = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column("text")]) // BLOCK_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                texts = [t.as_buffer().to_pybytes() if t.is_valid else None for t in part.column("text")]
                with np.errstate(over="ignore"):
                    out = list(finder.block([t or b"" for t in texts]))
                best = [best_of(r) for _, r, _ in out]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([n for n, _, _ in out], pa.int64()),
                     pa.array([[struct(x) for x in r] for _, r, _ in out], pa.list_(triple)),
                     pa.array([struct(x) if x else None for x in best], triple),
                     pa.array([None if t is None else c for t, (_, _, c) in zip(texts, out, strict=True)],
                              pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "best", "collapsed"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       docs["text"].cast("string").cast("binary").alias("text")).mapInArrow(trimmed(run), RUNS)


@F.arrow_udf(StringType())
def with_planted_runs(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The text; where crc32 of the id as text is divisible by 10, its words from one place on
    repeat with a period that this checksum sets."""

    def planted(doc_id: int | None, text: str | None) -> str | None:
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        words = text.encode().split() if text is not None and h % 10 == 0 else []
        if not words:
            return text
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join([*words[:a], *(words[a + i % p] for i in range(n - a))]).decode()

    for ids, texts in batches:
        yield pa.array(map(planted, ids.to_pylist(), texts.to_pylist()), pa.string())
    release()


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document's words, the best one and digests of all runs and of the collapsed text."""
    docs = read_table(spark, sf_dir, "documents")
    doc_id = docs["doc_id"].cast("long")
    found = periodic_runs(docs.select(doc_id.alias("doc_id"), with_planted_runs(doc_id, docs["text"]).alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    every = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(every, 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))
