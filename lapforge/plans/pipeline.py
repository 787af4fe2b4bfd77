"""Warehouse pipeline queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapforge.functions import full_name
from lapforge.operators.clean import clean_races as _clean
from lapforge.operators.clean import dedup_first
from lapforge.operators.ordering import rank_min
from lapforge.plans.model import Model
from lapforge.plans.standings import season_points


def raw_races(m: Model) -> DataFrame:
    """Raw race export as strings, one line per result (so race ids repeat), with
    padded names: what the CSV landing would hold."""
    li = m.table("lineitem", "l_orderkey")
    o = m.table("orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("l_orderkey").cast("string").alias("raceId"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.month("o_orderdate").cast("string").alias("round"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("name"),
    )


def clean_races(m: Model) -> DataFrame:
    """Q18 on the mapped data."""
    return _clean(raw_races(m))


def transform_results(m: Model) -> DataFrame:
    """Q19: clean points (own points if position 1..10, else 0) summed per
    (season, driver, code, constructor) with the count of positions and
    ``rank()`` in season by total points."""
    agg = m.season_stats().select("season", "driver_id", "constructor_id",
                                  F.col("clean_points").alias("total_points"), "position_count")
    ranked = rank_min(agg, ["season"],
                      [F.col("total_points").desc(), F.col("driver_id").asc(),
                       F.col("constructor_id").asc()],
                      ["total_points"], name="season_rank")
    d = m.drivers().select("driver_id", F.col("driver_code").alias("code"))
    return ranked.join(d, "driver_id", "left").select("season", "driver_id", "code", "constructor_id", "total_points",
                         "position_count", "season_rank")


def mart_season_standings(m: Model) -> DataFrame:
    """Q20: season standings mart: inner joins to both dimensions (facts with an
    unknown key drop out, see the orphan check), points, races, wins, podiums,
    and ``rank()`` in season."""
    per = m.season_stats().select(
        "season", "driver_id", "constructor_id", F.col("points").alias("total_points"),
        F.col("races").alias("total_races"), "wins", "podiums")
    d = m.drivers().select("driver_id", "driver_code",
                           full_name("forename", "surname").alias("driver_name"))
    c = m.constructors()
    base = per.join(d.select("driver_id"), "driver_id", "left_semi") \
        .join(c.select("constructor_id"), "constructor_id", "left_semi")
    ranked = rank_min(base, ["season"], [F.col("total_points").desc(), F.col("driver_id").asc(),
                                         F.col("constructor_id").asc()],
                      ["total_points"], name="season_rank")
    return ranked.join(d, "driver_id").join(c, "constructor_id").select("season", "driver_id", "driver_code", "driver_name", "constructor_id",
                         "constructor_name", "total_points", "total_races", "wins", "podiums",
                         "season_rank")


def season_aggregates(m: Model) -> DataFrame:
    """Q24: driver season points with the change on the driver's previous season.

    The window is per driver over seasons: at most one row per season."""
    s = season_points(m.season_stats())
    w = Window.partitionBy("driver_id").orderBy("season")
    return s.select("driver_id", "season", "points",
                    F.lag("points").over(w).alias("prev_points"),
                    (F.col("points") - F.lag("points").over(w)).alias("delta"))


def dedup_results(m: Model) -> DataFrame:
    """Q27: one result per (race, driver): the first by the full row order."""
    f = m.race_facts()
    return dedup_first(f, ["race_id", "driver_id"])


def join_driver_constructor(m: Model) -> DataFrame:
    """J8 (pipeline stage 5): every result with its driver and constructor by
    left joins, so the row count is kept (a missing dimension row gives NULL names)."""
    r = m.results()
    d = m.drivers().select("driver_id", "driver_code",
                           full_name("forename", "surname").alias("driver_name"))
    c = m.constructors()
    return r.join(d, "driver_id", "left").join(c, "constructor_id", "left").select(
        "race_id", "season", "driver_id", "driver_code", "driver_name", "constructor_id",
        "constructor_name", "finish_position", "points")


def star_results(m: Model) -> DataFrame:
    """The results fact joined to its four dimensions (circuits, drivers,
    seasons, constructors) with inner joins."""
    from lapforge.operators.joins import star
    circuits = m.circuits().select("circuit_id", "circuit_name")
    drivers = m.drivers().select("driver_id", "driver_code")
    seasons = F.broadcast(m.seasons().withColumnRenamed("season_year", "season"))
    constructors = m.constructors()
    return star(m.results(), [(circuits, "circuit_id"), (drivers, "driver_id"),
                              (seasons, "season"), (constructors, "constructor_id")]) \
        .select("race_id", "season", "rule_era", "circuit_id", "circuit_name", "driver_id",
                "driver_code", "constructor_name", "finish_position", "points")
