"""Season standings.

All read the season aggregate: one row per season, driver and the constructor
stored in the fact, so a driver with two teams has two rows.  Rows are ranked on
their keys first; names join the ranked rows.  Ranking uses the distributed
``sequence_number`` (no single task per season).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.functions import full_name
from lapforge.operators.aggregates import share
from lapforge.operators.ordering import argmax_row, rank_first, rank_min, top_n
from lapforge.plans.common import finalize
from lapforge.plans.model import SEASON, TREND_DRIVERS, Model


def season_points(facts: DataFrame, keys: Sequence[str] = ("season", "driver_id")) -> DataFrame:
    """A1: sum of points per key (partial aggregation before the shuffle)."""
    return facts.groupBy(*keys).agg(F.sum("points").cast("bigint").alias("points"))


def with_driver_names(df: DataFrame, m: Model) -> DataFrame:
    """Attach code, name and team to rows keyed by driver_id and constructor_id."""
    d = m.drivers().select("driver_id", "driver_code",
                           full_name("forename", "surname").alias("driver_name"))
    c = m.constructors().withColumnRenamed("constructor_name", "team")
    return df.join(d, "driver_id", "left").join(c, "constructor_id", "left")


def standings(m: Model, season: int | None = None, drivers=None) -> DataFrame:
    """Season driver standings without rank: season, driver, team, points."""
    return with_driver_names(season_rows(m, season, drivers), m)


def season_rows(m: Model, season: int | None = None, drivers=None) -> DataFrame:
    """Season, driver, constructor, points (no names)."""
    return m.season_stats(season, drivers).select("season", "driver_id", "constructor_id", "points")


def standings_order():
    return [F.col("points").desc(), F.col("driver_id").asc(), F.col("constructor_id").asc()]

STANDINGS_COLS = ["season", "driver_id", "driver_code", "driver_name", "constructor_id",
                  "team", "points", "rank"]


def driver_standings(m: Model, season: int | None = None) -> DataFrame:
    """Q1: standings with rank by points, ties in driver order (pandas ``first``)."""
    ranked = rank_first(season_rows(m, season), ["season"], standings_order(), name="rank")
    return with_driver_names(ranked, m).select(*STANDINGS_COLS)


def season_kpis(m: Model, season: int = SEASON) -> DataFrame:
    """Q3: champion, its points, drivers and constructors of one season.

    One row even for an empty season (NULL champion, 0 counts)."""
    s = standings(m, season)
    champ = F.max_by(F.struct("driver_code", "points"),
                     F.struct(F.col("points"), -F.col("driver_id")))
    out = s.agg(
        champ.alias("_c"),
        F.count(F.lit(1)).alias("drivers"),
        F.countDistinct("team").alias("constructors"),
    )
    return finalize(out.select(
        F.lit(season).alias("season"),
        F.col("_c.driver_code").alias("champion"),
        F.col("_c.points").alias("champion_points"),
        "drivers", "constructors"))


def season_top(m: Model, season: int = SEASON, n: int = 10) -> DataFrame:
    """Q4: the season's first ``n`` by rank (a top-k, not a full ranking)."""
    top = top_n(standings(m, season), standings_order(), n)
    # rank of the k rows kept = their position in the same order (k rows only)
    from pyspark.sql import Window
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*standings_order())))
    return finalize(ranked.select(*STANDINGS_COLS))


def team_share(m: Model, season: int = SEASON, n: int = 6) -> DataFrame:
    """Q5: the season's top ``n`` constructors by driver points and their share of those n."""
    by_team = standings(m, season).groupBy("constructor_id", "team") \
        .agg(F.sum("points").cast("bigint").alias("points"))
    top = top_n(by_team, [F.col("points").desc(), F.col("constructor_id").asc()], n)
    return finalize(share(top, "points").select("constructor_id", "team", "points", "share"))


def points_trend(m: Model, drivers=TREND_DRIVERS) -> DataFrame:
    """Q6: points per season for chosen drivers, one query for all of them."""
    s = standings(m, drivers=drivers)
    return finalize(s.select("driver_id", "driver_code", "season", "points")
                    .orderBy("driver_id", "season"))


def rank_ties(m: Model) -> DataFrame:
    """SQL ``rank()`` of the standings: ties share a rank and leave a gap."""
    ranked = rank_min(season_rows(m), ["season"], standings_order(), ["points"], name="rank_min")
    return finalize(ranked.select("season", "driver_id", "points", "rank_min"))


def season_winners(m: Model) -> DataFrame:
    """Champion of every season (rank 1 under W1) by a partial ``min(struct)``."""
    s = season_rows(m)
    return argmax_row(s, ["season"], [-F.col("points"), F.col("driver_id"), F.col("constructor_id")],
                      ["driver_id", "points"])


def championships(m: Model) -> DataFrame:
    """Seasons won per driver (every driver that raced, 0 when none)."""
    wins = season_winners(m).groupBy("driver_id").agg(F.count(F.lit(1)).alias("championships"))
    raced = m.season_stats().select("driver_id").distinct()
    out = raced.join(wins, "driver_id", "left").na.fill(0, ["championships"])
    return finalize(out)
