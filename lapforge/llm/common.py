"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.session import scratch_path

FILTER_BITS = 1 << 26
FILTER_HASHES = 4
ARROW_ROWS = 1000
ARROW_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark only (the path may be any Hadoop path)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in small Arrow batches, unless the session says how many.

    A batch is held several times over: by the JVM outside its heap, in buffers that double
    as they grow, and by the Python worker; with Spark's 10,000 texts this adds up.
    """
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS),
                       ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, str(value))


Write = Callable[[DataFrame, str], DataFrame]


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder (or in ``folder``, which lies there).

    Cuts the lineage: later stages re-read the table, also after an executor is
    lost, so row order and generated ids in it never change.
    """
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[Write]:
    """A ``written`` whose tables are deleted when the block ends.

    What outlives the block must be written elsewhere within it; then nothing refers
    to the deleted tables, also when an executor is lost later.
    """
    folder = scratch_path(spark, name)
    try:
        yield lambda df, table: written(df, table, folder)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text with null as the empty string."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def doc_key(docs: DataFrame) -> list[Column]:
    """``did``, ``tk``: a null-free key of a document (its id and a digest of its text).

    Rows equal in both count as one document.
    """
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(-(1 << 63))).alias("did"),
            F.xxhash64(text_of(docs)).alias("tk")]


def hash_sample(rows: DataFrame, key: str, wanted: int, by: str | None = None,
                counts: dict | None = None) -> DataFrame:
    """About ``wanted`` rows (per value of ``by``), the same in every run.

    One count (per value; or pass ``counts``) fixes a threshold on a hash of ``key``;
    the rest is a filter, so no group is gathered anywhere.  The values of ``by`` come
    to the driver and must be few (labels, languages).
    """
    unit = F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    if by is None:
        n = rows.count()
        return rows.where(unit < wanted / n) if n > wanted else rows
    cut = F.lit(0.0)
    for value, n in (counts or value_counts(rows, by)).items():
        cut = F.when(F.col(by) == F.lit(value), F.lit(wanted / n)).otherwise(cut)
    return rows.where(unit < cut)


def value_counts(rows: DataFrame, by: str) -> dict:
    """Rows per value of a column with few values."""
    return {r[0]: r[1] for r in rows.groupBy(by).count().collect()}


def row_of(docs: DataFrame) -> Column:
    """All columns as one struct, so that no name clashes with those that an operator adds."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)).alias("row")


def maybe_in(keys: DataFrame) -> Callable[..., Column]:
    """A test of two-column keys against ``keys`` (two long columns): false means surely not in it.

    A Bloom filter of about ten bits a key, at most ``FILTER_BITS``, goes to the tasks.  More
    keys than it is made for pass more rows, but never miss one.  All bits of a key lie in one
    word, so a row looks up one number, without Python in the tasks.
    """
    size = min(FILTER_BITS, max(1 << 16, 1 << (10 * keys.count()).bit_length())) >> 6

    def word(a: Column, b: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(0), a, b), F.lit(size)).cast("int")

    def mask(a: Column, b: Column) -> Column:
        bits = (F.shiftright(F.xxhash64(F.lit(1), a, b), 6 * i).bitwiseAND(F.lit(63)).cast("int")
                for i in range(FILTER_HASHES))
        return reduce(Column.bitwiseOR, (F.call_function("shiftleft", F.lit(1).cast("long"), i) for i in bits))

    pair = [keys[c] for c in keys.columns]
    set_bits = keys.groupBy(word(*pair).alias("word")).agg(F.bit_or(mask(*pair)).alias("value")) \
        .toArrow()  # FILTER_BITS / 64 rows
    words = np.zeros(size, np.int64)
    words[set_bits["word"].to_numpy()] = set_bits["value"].to_numpy()
    table = pa.table({"words": pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), pa.array(words))})
    held = keys.sparkSession.createDataFrame(table).scalar()

    def test(a: Column, b: Column) -> Column:
        return F.get(held, word(a, b)).bitwiseAND(mask(a, b)) == mask(a, b)

    return test


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the documents whose ``doc_key`` is in ``keys`` (did, tk).

    Only the texts of documents that may be in ``keys`` are joined; all others stay where
    they are.
    """
    keyed = docs.select(row_of(docs), *doc_key(docs))
    maybe = maybe_in(keys.select("did", "tk"))(F.col("did"), F.col("tk"))
    found = keyed.where(maybe).join(keys.select("did", "tk").distinct(), ["did", "tk"], "left_anti")
    return keyed.where(~maybe).select("row.*").unionByName(found.select("row.*"))


def release() -> None:
    """Hand memory that this Python worker has freed back to the system.

    Workers live on for later tasks and stages; without this an idle one keeps the
    arrays, tokenizers and tables that its last task has freed, on top of what the
    executor's next stage needs.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) \
        -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` of a mapInArrow, with ``release`` at the task's end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return whole
