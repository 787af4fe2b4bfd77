"""Table versions that are switched at once.

A table is a folder with data folders ``batch=<id>/`` and numbered manifests in
``_versions/``.  A manifest names the schema and, per partition folder, the batch that holds
it.  A writer first writes a whole new batch and then puts the next manifest in place by a
rename: readers see the old version or the new one, a job that dies before the rename changes
nothing, and of two writers that started from the same version the second one fails.
Untouched partitions are not written again.  On object stores without an atomic rename, point
the table at a store that has one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

VERSIONS = "_versions"


class Conflict(RuntimeError):
    """Another writer has put the same version in place."""


def store_of(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, path: str) -> tuple[int, StructType, dict[str, str]]:
    """(version, schema, partition folder -> batch) of the table; version 0 where there is none."""
    folder, fs = store_of(spark, f"{path}/{VERSIONS}")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    last = max((int(n) for n in names if n.isdigit()), default=0)
    if not last:
        return 0, StructType([]), {}
    held = json.loads(spark.read.text(f"{path}/{VERSIONS}/{last}", wholetext=True).first()[0])
    return last, StructType.fromJson(held["schema"]), held["parts"]


def write_batch(df: DataFrame, path: str, partition_col: str | None = None) -> dict[str, str]:
    """Write ``df`` as a new batch; partition folder -> batch.  Nothing reads it before ``commit``."""
    batch = uuid.uuid4().hex
    w = df.write.partitionBy(partition_col) if partition_col else df.write
    w.parquet(f"{path}/batch={batch}")
    folder, fs = store_of(df.sparkSession, f"{path}/batch={batch}")
    if not partition_col:
        return {"": batch}
    return {s.getPath().getName(): batch for s in fs.listStatus(folder) if s.isDirectory()}


def commit(spark: SparkSession, path: str, version: int, schema: StructType, parts: dict[str, str]) -> None:
    """Put manifest ``version`` in place by a rename."""
    final, fs = store_of(spark, f"{path}/{VERSIONS}/{version}")
    draft, _ = store_of(spark, f"{path}/{VERSIONS}/.{uuid.uuid4().hex}")
    fs.mkdirs(final.getParent())
    fields = [StructField(f.name, f.dataType, True) for f in schema.fields]
    out = fs.create(draft)
    out.write(json.dumps({"schema": StructType(fields).jsonValue(), "parts": parts}).encode())
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise Conflict(f"version {version} of {path} is there already")


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The current version; columns that a batch lacks are NULL there."""
    version, schema, parts = current(spark, path)
    if not version:
        raise FileNotFoundError(f"no version in {path}")
    if not parts:
        return spark.createDataFrame([], schema)
    paths = [f"{path}/batch={b}/{p}".rstrip("/") for p, b in sorted(parts.items())]
    whole = StructType([*schema.fields, StructField("batch", StringType())])
    return spark.read.schema(whole).option("basePath", path).parquet(*paths).select(*schema.names)


def overwrite(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """The rows and the schema of ``df`` replace the table's."""
    version = current(df.sparkSession, path)[0]
    commit(df.sparkSession, path, version + 1, df.schema, write_batch(df, path, partition_col))


def replace_partitions(spark: SparkSession, path: str, rows: DataFrame, partition_col: str,
                       base: tuple[int, StructType, dict[str, str]], every: bool = False) -> None:
    """``rows`` replace the partitions that they have (``every``: all); the others stay
    as they are.  ``base`` is the version that the rows were made from."""
    version, schema, parts = base
    fresh = write_batch(rows, path, partition_col)
    kept = {} if every else parts
    fields = list(rows.schema.fields) + [f for f in schema.fields if not every and f.name not in rows.columns]
    commit(spark, path, version + 1, StructType(fields), kept | fresh)
