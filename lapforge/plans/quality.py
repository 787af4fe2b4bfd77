"""Quality reports over the mapped facts (D1-D8) and the table inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.operators.quality import (ColumnSpec, foreign_keys, greater_than, in_range,
                                        matches_map, not_null, run_checks, schema_check,
                                        unique_key)
from lapforge.plans.model import Model
from lapforge.plans.standings import season_points

# The declared source schema of the race-results fact (types and
# VARCHAR length as the reference lists them).
RESULTS_SOURCE_SCHEMA = [
    ColumnSpec("race_id", "int"),
    ColumnSpec("season", "smallint"),
    ColumnSpec("round", "tinyint"),
    ColumnSpec("circuit_id", "int"),
    ColumnSpec("driver_id", "int"),
    ColumnSpec("constructor_id", "int"),
    ColumnSpec("grid_position", "tinyint"),
    ColumnSpec("finish_position", "tinyint"),
    ColumnSpec("points", "float"),
    ColumnSpec("laps_completed", "tinyint"),
    ColumnSpec("status", "string", 32),
    ColumnSpec("fastest_lap_time", "float"),
]


def dq_report(m: Model) -> DataFrame:
    """One aggregate pass per fact, one row per check."""
    r = run_checks(m.results(), [
        not_null("driver_id"),
        in_range("finish_position", 1, 20),
        matches_map("points", "finish_position"),
        in_range("season", 1950, 2024),
    ], "fact_race_results")
    laps = run_checks(m.laps(), [greater_than("lap_time", 60)], "fact_lap_times")
    return r.unionByName(laps)


def dq_duplicates(m: Model) -> DataFrame:
    """Duplicate (race, driver) keys in the results fact."""
    return unique_key(m.race_facts(), ["race_id", "driver_id"])


def dq_orphans(m: Model) -> DataFrame:
    """Foreign keys of the results fact without a dimension row, in one scan of the fact."""
    return foreign_keys(m.results(), [
        ("constructor_id", m.constructors(), "constructor_id", "fk:constructor_id->dim_constructors"),
        ("circuit_id", m.circuits(), "circuit_id", "fk:circuit_id->dim_circuits")])


def dq_schema(m: Model) -> DataFrame:
    """The results fact against its declared source schema."""
    return schema_check(m.results(), RESULTS_SOURCE_SCHEMA)


def _inventory_row(df: DataFrame, table: str, layer: str, grain: list[str]) -> DataFrame:
    """Rows and distinct grain keys in one two-level aggregate (rows per grain
    key, then totals) instead of count + count(distinct), which expands rows.
    Keys with a NULL part are not counted as distinct keys (as count(distinct))."""
    per_key = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("_lf_n"))
    not_null = None
    for g in grain:
        c = F.col(g).isNotNull()
        not_null = c if not_null is None else not_null & c
    return per_key.agg(F.coalesce(F.sum("_lf_n"), F.lit(0)).cast("bigint").alias("rows"),
                       F.count_if(not_null).alias("distinct_grain")) \
        .select(F.lit(table).alias("table"), F.lit(layer).alias("layer"), "rows",
                F.lit(" + ".join(grain)).alias("grain"), "distinct_grain",
                (F.col("rows") == F.col("distinct_grain")).alias("grain_unique"))


def table_inventory(m: Model) -> DataFrame:
    """Row count per model table and whether its stated grain is unique."""
    parts = [
        _inventory_row(m.race_facts(), "fact_race_results", "fact", ["race_id", "driver_id"]),
        _inventory_row(m.laps(), "fact_lap_times", "fact", ["season", "driver_id", "event_id"]),
        _inventory_row(m.drivers(), "dim_drivers", "dimension", ["driver_id"]),
        _inventory_row(m.constructors(), "dim_constructors", "dimension", ["constructor_id"]),
        _inventory_row(m.circuits(), "dim_circuits", "dimension", ["circuit_id"]),
        _inventory_row(season_points(m.season_stats()), "agg_season_points", "mart",
                       ["season", "driver_id"]),
        _inventory_row(m.season_stats().select("season", "constructor_id").distinct(),
                       "agg_constructor_pts", "mart", ["season", "constructor_id"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pipeline_run_log(m: Model) -> DataFrame:
    """The run log of this engine's own pipeline: one row per table with its
    layer and row count (raw inputs, warehouse facts, marts), status from the
    count (an empty table is a failed load)."""
    from lapforge.plans.teams import team_points
    tables = [
        ("lineitem.parquet", "raw", m.table("lineitem", "l_orderkey")),
        ("orders.parquet", "raw", m.table("orders", "o_orderkey")),
        ("supplier.parquet", "raw", m.table("supplier", "s_suppkey")),
        ("nation.parquet", "raw", m.table("nation", "n_nationkey")),
        ("part.parquet", "raw", m.table("part", "p_partkey")),
        ("events.parquet", "raw", m.table("events", "event_id")),
        ("fact_race_results", "warehouse", m.results().select("race_id")),
        ("fact_lap_times", "warehouse", m.laps().select("event_id")),
        ("agg_season_points", "mart", season_points(m.season_stats())),
        ("agg_constructor_pts", "mart", team_points(m)),
    ]
    out = None
    for name, layer, df in tables:
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.lit(layer).alias("layer"), "rows",
            F.when(F.col("rows") > 0, "SUCCESS").otherwise("FAILED").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out


def layer_summary(m: Model) -> DataFrame:
    """O1 on the engine's own run log: rows, tables and failures per layer,
    and the rows ingested in the raw layer."""
    from lapforge.plans.ops import layer_summary as summarize
    return summarize(pipeline_run_log(m))
