"""Exact de-duplication with a cuckoo-filter index (operator 10).

Copies are first summed per digest and salt on the map side, so a text that makes
up a third of the rows reaches its bucket as at most ``SALTS`` rows.  Each bucket
task streams its rows through a cuckoo filter of 16-bit fingerprints: a miss is a
new live digest and is inserted; a hit is verified against the bucket's content
(full SHA-256, byte length and a second hash) and updates the group or, when it
was a false hit, is inserted as well.  Digests can be taken down: their
fingerprints are deleted.  When an insertion finds no place the filter is rebuilt
at twice the size from the stored keys.

Defined cases: null text counts as empty; the largest doc_id of a group stays and
a null doc_id stays only where a group has no other; of repeated rows (same id
and text) one stays; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.llm.common import read_table, text_of, trimmed, written

SALTS = 32
BUCKET_ROWS = 200_000
SLOTS = 4
MAX_KICKS = 200


class CuckooFilter:
    """Approximate set of 64-bit digests with deletion; no false negatives."""

    def __init__(self, buckets: int = 1 << 10):
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.table = np.zeros((buckets, SLOTS), np.uint16)

    @staticmethod
    def _mark(digest: int) -> int:
        return (digest >> 48) or 1

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _places(self, digest: int) -> tuple[int, int, int]:
        mark = self._mark(digest)
        first = digest & self.mask
        return mark, first, self._other(first, mark)

    def __contains__(self, digest: int) -> bool:
        mark, a, b = self._places(digest)
        return bool((self.table[a] == mark).any() or (self.table[b] == mark).any())

    def add(self, digest: int) -> bool:
        """Insert; False when the filter is too full (the digest is then not in it)."""
        mark, a, b = self._places(digest)
        for bucket in (a, b):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        bucket, moved = b, []
        for k in range(MAX_KICKS):
            slot = k % SLOTS
            moved.append((bucket, slot))
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket = self._other(bucket, mark)
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        for bucket, slot in reversed(moved):  # undo
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
        return False

    def remove(self, digest: int) -> None:
        """Delete one stored digest (it must have been inserted)."""
        mark, a, b = self._places(digest)
        for bucket in (a, b):
            found = np.flatnonzero(self.table[bucket] == mark)
            if len(found):
                self.table[bucket, found[0]] = 0
                return

    def rebuild(self, digests: Iterator[int]) -> None:
        """Twice the size, refilled from the stored keys."""
        keys, buckets = list(digests), 2 * (self.mask + 1)
        while True:
            self._empty(buckets)
            if all(self.add(d) for d in keys):
                return
            buckets *= 2


class Bucket:
    """Live digests of one bucket: the filter and the content it is checked against."""

    def __init__(self):
        self.filter = CuckooFilter()
        self.content: dict[tuple, list] = {}  # (sha, bytes, check) -> [largest id, rows]

    def put(self, key: tuple, doc_id: int | None, rows: int) -> None:
        digest = int(key[0][:16], 16)
        if digest in self.filter:
            live = self.content.get(key)  # a hit is verified against the content
            if live is not None:
                if doc_id is not None and (live[0] is None or doc_id > live[0]):
                    live[0] = doc_id
                live[1] += rows
                return
        self.content[key] = [doc_id, rows]
        if not self.filter.add(digest):
            self.filter.rebuild(int(k[0][:16], 16) for k in self.content)

    def drop(self, key: tuple) -> bool:
        """Take a digest down; False when it is not live."""
        if int(key[0][:16], 16) not in self.filter or self.content.pop(key, None) is None:
            return False
        self.filter.remove(int(key[0][:16], 16))
        return True


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, n_bytes, check of every row."""
    text = text_of(docs)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.sha2(text.cast("binary"), 256).alias("text_sha256"),
                       F.octet_length(text).cast("long").alias("n_bytes"),
                       F.xxhash64(text).alias("check"))


GROUPS = "text_sha256 string, n_bytes long, check long, keep_id long, group_size long"


def index(rows: DataFrame, taken_down: DataFrame | None = None,
          bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The live digests of ``rows`` (from ``digests``): one row per group.

    ``taken_down`` (text_sha256, n_bytes, check) names digests to delete again.
    """
    key = ["text_sha256", "n_bytes", "check"]
    salt = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(SALTS))
    summed = rows.groupBy(*key, salt.alias("salt")).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).drop("salt") \
        .withColumn("down", F.lit(False))
    if taken_down is not None:
        summed = summed.unionByName(taken_down.select(
            *key, F.lit(None).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
            F.lit(True).alias("down")).distinct())
    summed = written(summed, "digest-sums")
    n = max(1, -(-summed.count() // bucket_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, down = Bucket(), []
        for batch in batches:
            for *k, keep, size, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if gone:
                    down.append(tuple(k))
                else:
                    bucket.put(tuple(k), keep, size)
        for k in down:
            bucket.drop(k)
        rows = [(*k, *v) for k, v in bucket.content.items()]
        for i in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows[i:i + 10_000], strict=True),
                                               [pa.string()] + [pa.int64()] * 4, strict=True)],
                [f.split()[0] for f in GROUPS.split(", ")])

    return summed.repartition(n, "text_sha256").mapInArrow(trimmed(run), GROUPS)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    rows = digests(docs)
    groups = index(rows)
    key = ["text_sha256", "n_bytes", "check"]
    same = rows.groupBy(*key, "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    return same.join(groups, key) \
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")) \
        .select("doc_id", "keep_id", "group_size",
                (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                "text_sha256")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id of its text's largest copy."""
    return exact_dedup(read_table(spark, sf_dir, "documents"))


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
