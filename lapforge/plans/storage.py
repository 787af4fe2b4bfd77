"""Write-and-read-back queries for the sinks.

Each call writes under a fresh folder of the shared checkpoint directory and
returns the table as read back, so the check compares the final stored state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.functions import to_int
from lapforge.plans.career import career_stats
from lapforge.plans.model import Model
from lapforge.plans.pipeline import mart_season_standings
from lapforge.plans.standings import standings
from lapforge.session import scratch_path
from lapforge.sinks import append_load as _append
from lapforge.sinks import evolve, export, land, merge_mart, read_evolved
from lapforge.sinks.catalog import inventory, land_table, quoted
from lapforge.sources.files import read_raw_csv
from lapforge.sources.tables import read_table

SPLIT_SEASON = 1999


def early(season: int = SPLIT_SEASON):
    """Before ``season``; a NULL season counts as late, so the two sides hold every row."""
    return F.coalesce(F.col("season") < season, F.lit(False))


def csv_roundtrip(m: Model) -> DataFrame:
    """S12 + S1: standings exported as header CSV, read back as strings, typed again."""
    s = standings(m).select("season", "driver_id", "driver_code", "points")
    path = scratch_path(m.spark, "csv_roundtrip")
    export(s, path, "csv")
    raw = read_raw_csv(m.spark, path)
    return raw.select(to_int("season").alias("season"),
                      F.col("driver_id").try_cast("bigint").alias("driver_id"),
                      "driver_code",
                      F.col("points").try_cast("bigint").alias("points"))


MART_KEYS = ["season", "driver_id"]


def merge_mart_query(m: Model) -> DataFrame:
    """The season-standings mart loaded for early seasons, then merged with a
    recompute of the later seasons (one season overlaps and is replaced)."""
    spark = m.spark
    path = scratch_path(spark, "mart_season_standings")
    mart = mart_season_standings(m)
    merge_mart(spark, path, mart.filter(early()), MART_KEYS)
    merge_mart(spark, path, mart.filter(~early(SPLIT_SEASON - 1)), MART_KEYS)
    return read_evolved(spark, path).select(*mart.columns)


def schema_evolution(m: Model) -> DataFrame:
    """An early batch without ``wins`` and a later batch with it, written
    as separate files and read back as one table (``wins`` NULL where absent)."""
    spark = m.spark
    stats = career_stats(m.race_facts(), ["season", "driver_id"])
    v1 = stats.filter(early()).select("season", "driver_id", "points")
    v2 = stats.filter(~early()).select("season", "driver_id", "points",
                                                              "wins")
    path = scratch_path(spark, "evolving")
    v1.write.parquet(f"{path}/batch=1")
    v2.write.parquet(f"{path}/batch=2")
    back = read_evolved(spark, path)
    # the same union done in memory must agree with the evolved read
    assert set(evolve(v1, v2).columns) == set(back.columns) - {"batch"}
    return back.select("season", "driver_id", "points", "wins")


def append_load(m: Model) -> DataFrame:
    """S8 + S10 + S2: two appends into a new table, read back through the layer path."""
    spark = m.spark
    s = standings(m).select("season", "driver_id", "points")
    layer = scratch_path(spark, "warehouse")
    n1 = _append(s.filter(early()), f"{layer}/agg_season_points")
    n2 = _append(s.filter(~early()), f"{layer}/agg_season_points")
    back = read_table(spark, layer, "agg_season_points")
    land(back, f"{layer}/agg_season_points_by_season")
    landed = read_table(spark, layer, "agg_season_points_by_season")
    return landed.select("season", "driver_id", "points",
                         F.lit(n1 + n2).cast("bigint").alias("rows_loaded"))


def _catalog_database(m: Model) -> str:
    """The results in two landings (early seasons, then the others with one of the early ones
    again) and the season aggregate, as catalog tables of a database of their own."""
    path = scratch_path(m.spark, "catalog")
    database = "lapforge_" + path.rsplit("-", 1)[-1]
    results = m.results().select("race_id", "driver_id", "constructor_id", "points", "season")
    land_table(results.filter(early()), database, "fact_race_results", f"{path}/fact_race_results")
    land_table(results.filter(~early(SPLIT_SEASON - 1)), database, "fact_race_results", f"{path}/fact_race_results")
    stats = m.season_stats().select("driver_id", "constructor_id", "points", "races", "season")
    land_table(stats, database, "agg_season_points", f"{path}/agg_season_points")
    return database


def catalog_inventory(m: Model) -> DataFrame:
    """S10 + O5: tables of the catalog with their listed partitions and rows."""
    return inventory(m.spark, _catalog_database(m))


def catalog_results(m: Model) -> DataFrame:
    """Points and rows per season of the landed fact, read by its catalog name."""
    return m.spark.table(quoted(_catalog_database(m), "fact_race_results")).groupBy("season").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("points").cast("bigint").alias("points"))
