"""Stored-table scans.

Every scan names its columns, so the parquet reader only decodes those
(``ReadSchema`` in the plan); filters written on scan columns reach the reader
as ``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_parquet_table(spark: SparkSession, base: str, name: str,
                       columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(base, name))
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, layer_path: str, name: str) -> DataFrame:
    """A table written by a sink of this engine: ``<layer_path>/<name>`` (parquet)."""
    return spark.read.parquet(f"{layer_path.rstrip('/')}/{name}")
