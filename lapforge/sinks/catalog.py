"""Landing into partitioned catalog tables and the inventory of a database.

A catalog table is external parquet with its partitions listed in the catalog: a landing of
some partitions writes their folders and adds them, the rest is neither listed nor touched,
and ``partition = x`` is resolved by the catalog without listing the table's folder.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.sinks.versions import store_of

HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def literal(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create(spark: SparkSession, database: str, table: str, schema, path: str, partition_col: str) -> None:
    """The database and the table at ``path``, where they are not there yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(database, table)} ({columns}) USING parquet "
              f"PARTITIONED BY ({quoted(partition_col)}) LOCATION {literal(path)}")


def land_table(df: DataFrame, database: str, table: str, path: str, partition_col: str = "season") -> None:
    """``df`` replaces the partitions that it has; new ones are added to the catalog.

    The rebalance lets AQE split a partition of any size over several write tasks.  The folders
    are written first (a job that dies before their commit leaves the old ones) and listed in the
    catalog after; a landing that is repeated writes and adds the same.  NULL is a partition too."""
    spark = df.sparkSession
    create(spark, database, table, df.schema, path, partition_col)
    df.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(partition_col).parquet(path)
    name = quoted(database, table)
    folder, store = store_of(spark, path)
    there = {s.getPath().getName() for s in store.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()}
    known = {r[0] for r in partitions(spark, database, table).collect()}  # one per partition folder
    values = sorted(unquote(n.split("=", 1)[1]) for n in there - known)
    if values:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(
            f"PARTITION ({quoted(partition_col)} = {'null' if v == HIVE_NULL else literal(v)})" for v in values))
    spark.catalog.refreshTable(name)


def partitions(spark: SparkSession, database: str, table: str) -> DataFrame:
    """The partitions as the catalog lists them: ``partition`` text."""
    return spark.sql(f"SHOW PARTITIONS {quoted(database, table)}")


def inventory(spark: SparkSession, database: str) -> DataFrame:
    """O5 from the catalog: table, partitions listed and rows, one row per table.

    The tables of a database are a short list of names; each is counted by Spark."""
    out = None
    for t in sorted(t.name for t in spark.catalog.listTables(quoted(database))):
        listed = partitions(spark, database, t).agg(F.count(F.lit(1)).alias("partitions"))
        rows = spark.table(quoted(database, t)).agg(F.count(F.lit(1)).alias("rows"))
        row = rows.select(F.lit(t).alias("table"), listed.scalar().alias("partitions"), "rows")
        out = row if out is None else out.unionByName(row)
    return out if out is not None else spark.createDataFrame([], "table string, partitions bigint, rows bigint")
