"""Line de-duplication by a suffix array over line ids (operator 2).

Every non-blank line is a 128-bit id; a document is the sequence of its line ids.
Distributed prefix doubling ranks the suffixes: round 0 ranks the distinct repeated
lines, round k + 1 ranks the distinct pairs (rank of the first 2^k lines, rank of the
next 2^k), always by a global sort of *distinct* keys, so no hot line or passage is
ever one sorted group.  Positions whose prefix occurs once are discarded at once.
Suffixes of equal rank form an interval with a common prefix of at least 2^k lines.

A run of lines counts when it holds at least ``min_words`` words.  For every line the
shortest such run that starts there and the shortest that ends there are looked up;
a run of l lines is named by its length and the ranks of its first and last 2^k lines
(2^k <= l), so runs of equal name are one interval of common prefix l.  In each
interval the first run (by doc_id, then place) stays and the lines of all later ones
are deleted.  The union of these runs is exactly the union of all maximal repeated
runs of at least ``min_words`` words, so rounds stop at the longest such run.

Defined cases: null text stays null and has no lines; blank lines belong to no run
and stay; lines are compared without white space at their ends; rows equal in id and
text count as one document and are returned alike; a null doc_id sorts first; an
overlapping repeat inside one document counts as later; an empty table gives an
empty result; other columns pass through, but one named ``lines_removed`` is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lapforge.llm.common import (Write, doc_key, maybe_in, read_table, release, row_of, trimmed, workspace,
                                 written)

MIN_WORDS = 50
KEY = ["did", "tk"]
LINES = "did long, tk long, pos int, h1 long, h2 long, runs array<int>"


def runs_of(words: np.ndarray, min_words: int) -> list[list[int]]:
    """Per line the lengths of the shortest counting runs that start there or are the
    shortest to their last line."""
    n = len(words)
    total = np.concatenate(([0], np.cumsum(words)))
    out: list[set[int]] = [set() for _ in range(n)]
    ends = np.searchsorted(total, total[:-1] + min_words)
    starts = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    for i, e in enumerate(ends.tolist()):
        if e <= n:
            out[i].add(e - i)
    for e, s in enumerate(starts.tolist()):
        if s >= 0:
            out[s].add(e + 1 - s)
    return [sorted(r) for r in out]


def lines_of(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per non-blank line (schema ``LINES``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                columns: list[list] = [[] for _ in range(6)]
                for did, tk, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    lines = [x for x in map(str.strip, text.split("\n")) if x]
                    words = np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))
                    digests = b"".join(hashlib.blake2b(x.encode(), digest_size=16).digest() for x in lines)
                    pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
                    for c, v in zip(columns, ([did] * len(lines), [tk] * len(lines), range(len(lines)),
                                              pair[:, 0].tolist(), pair[:, 1].tolist(),
                                              runs_of(words, min_words)), strict=True):
                        c.extend(v)
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["did", "tk", "pos", "h1", "h2", "runs"])

    return docs.where(docs["text"].isNotNull()).select(*doc_key(docs), docs["text"].cast("string").alias("text")) \
        .mapInArrow(trimmed(run), LINES)


def ranked(rows: DataFrame, a: str, b: str, name: str, write: Write) -> DataFrame:
    """Order-preserving ranks of the (a, b) that occur more than once: a, b, rank."""
    twice = rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return write(twice.orderBy(a, b).select(a, b, F.monotonically_increasing_id().alias("rank")), name)


def suffix_ranks(lines: DataFrame, write: Write = written) -> Iterator[tuple[int, DataFrame]]:
    """(k, did, tk, pos, rank): ranks of the first 2^k lines of each suffix, repeated ones only.

    At k = 0 the rows carry ``runs`` as well.
    """
    level = write(
        lines.join(ranked(lines, "h1", "h2", "line-ranks", write), ["h1", "h2"])
        .select(*KEY, "pos", "rank", "runs").dropDuplicates([*KEY, "pos"]), "line-level")
    k = 0
    while True:
        yield k, level
        step = 1 << k
        ahead = level.select(*KEY, (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"))
        pairs = level.select(*KEY, "pos", "rank").withColumnRenamed("rank", "lead").join(ahead, [*KEY, "pos"])
        level = write(pairs.join(ranked(pairs, "lead", "next", "line-ranks", write), ["lead", "next"])
                      .select(*KEY, "pos", "rank"), "line-level")
        k += 1


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """did, tk, gone: the places (among non-blank lines) of the lines to delete per document."""
    with workspace(docs.sparkSession, "line-dedup") as write:
        lines = write(lines_of(docs, min_words), "lines")
        found, longest, windows = None, None, None  # every round is a plan of its own, or the driver holds all in one
        for k, level in suffix_ranks(lines, write):
            if windows is None:
                windows = level.select(*KEY, "pos", F.explode("runs").alias("len"))
                longest = windows.agg(F.max("len")).first()[0] or 0
            size = 1 << k
            if size > longest:
                break
            own = windows.where((F.col("len") >= size) & (F.col("len") < 2 * size))
            last = level.select(*KEY, F.col("pos").alias("end"), F.col("rank").alias("last"))
            named = own.join(level.select(*KEY, "pos", F.col("rank").alias("head")), [*KEY, "pos"]) \
                .withColumn("end", F.col("pos") + F.col("len") - size).join(last, [*KEY, "end"]) \
                .select(*KEY, "pos", "len", "head", "last")
            place = F.struct(*KEY, "pos")
            first = named.groupBy("len", "head", "last").agg(F.min(place).alias("first"),
                                                             F.count(F.lit(1)).alias("n")).where("n > 1")
            later = write(named.join(first.drop("n"), ["len", "head", "last"]).where(place != F.col("first"))
                          .select(*KEY, "pos", "len"), "later-runs")
            found = later if found is None else found.unionByName(later)
        if found is None:
            found = windows.select(*KEY, "pos", "len").where(F.lit(False))
        return written(found.select(*KEY, F.explode(F.sequence("pos", F.col("pos") + F.col("len") - 1)).alias("pos"))
                       .groupBy(*KEY).agg(F.collect_set("pos").alias("gone")), "lines-gone")


def left_of(text: str, gone: list[int]) -> str:
    """The text without its non-blank lines at the places ``gone``."""
    drop, kept, place = set(gone), [], 0
    for line in text.split("\n"):
        if not line.strip():
            kept.append(line)
            continue
        if place not in drop:
            kept.append(line)
        place += 1
    return "\n".join(kept)


@F.arrow_udf(StringType())
def without_lines(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """``left_of`` where there is a text and something to delete, else the text itself."""
    for texts, places in batches:
        yield pa.array([left_of(t, g) if t is not None and g is not None else t
                        for t, g in zip(texts.to_pylist(), places.to_pylist(), strict=True)], pa.string())
    release()


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies of repeated runs deleted, and ``lines_removed``.

    Texts that surely lose nothing stay where they are; the others meet their lines in a
    merge join, at every size.
    """
    gone = deleted_lines(docs, min_words)
    keyed = docs.select(row_of(docs), *doc_key(docs))
    maybe = maybe_in(gone.select(*KEY))(F.col("did"), F.col("tk"))
    changed = keyed.where(maybe).join(gone.hint("merge"), KEY, "left")

    def columns(text: Column, removed: Column) -> list[Column]:
        return [*(text.alias(c) if c == "text" else F.col("row").getField(c).alias(c)
                  for c in docs.columns if c != "lines_removed"), removed.cast("long").alias("lines_removed")]

    return keyed.where(~maybe).select(*columns(F.col("row.text").cast("string"), F.lit(0))).unionByName(changed.select(
        *columns(without_lines(F.col("row.text").cast("string"), F.col("gone")), F.coalesce(F.size("gone"), F.lit(0)))))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated runs of lines."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "lines_removed", "text")


OP2_SQL = f"""
WITH raw AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS place,
         unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL),
seq AS (
  SELECT doc_id, place, regexp_replace(regexp_replace(line, '^\\s+', ''), '\\s+$', '') AS l,
         row_number() OVER (PARTITION BY doc_id ORDER BY place) AS pos
  FROM raw WHERE regexp_matches(line, '\\S')),
cum AS (
  SELECT *, sum(len(string_split_regex(l, '\\s+'))) OVER (PARTITION BY doc_id ORDER BY pos) AS upto,
         len(string_split_regex(l, '\\s+')) AS w
  FROM seq),
runs AS (
  SELECT a.doc_id, a.pos AS s, min(b.pos) AS e FROM cum a JOIN cum b
    ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.w >= {MIN_WORDS} GROUP BY 1, 2
  UNION
  SELECT b.doc_id, max(a.pos) AS s, b.pos AS e FROM cum a JOIN cum b
    ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.w >= {MIN_WORDS} GROUP BY b.doc_id, b.pos),
named AS (
  SELECT r.doc_id, s, e, string_agg(l, chr(10) ORDER BY pos) AS content
  FROM runs r JOIN seq q ON q.doc_id = r.doc_id AND q.pos BETWEEN s AND e GROUP BY 1, 2, 3),
later AS (
  SELECT doc_id, s, e FROM (
    SELECT *, row_number() OVER (PARTITION BY content, e - s ORDER BY doc_id, s) AS k FROM named) WHERE k > 1),
gone AS (SELECT DISTINCT q.doc_id, q.place FROM later r JOIN seq q ON q.doc_id = r.doc_id AND q.pos BETWEEN s AND e)
SELECT d.doc_id, count(g.place) AS lines_removed,
       CASE WHEN count(g.place) < count(r.place) THEN string_agg(r.line, chr(10) ORDER BY r.place) FILTER (WHERE g.place IS NULL)
            WHEN d.text IS NOT NULL THEN '' END AS text
FROM documents d LEFT JOIN raw r ON r.doc_id = d.doc_id
LEFT JOIN gone g ON g.doc_id = r.doc_id AND g.place = r.place
GROUP BY d.doc_id, d.text
"""
