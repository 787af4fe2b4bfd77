"""Constructor queries.

Team standings are one row per (season, constructor), summed from the season
aggregate (whose constructor is the fact's own key), and
only the names join the small result.  Windows here are
partitioned by constructor (at most one row per season) or by season over the
constructors (bounded by the nation table), so no window sees an unbounded
group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapforge.operators.aggregates import pivot_sum
from lapforge.operators.joins import scalar_row, semi_topn
from lapforge.operators.ordering import n_largest, top_n, top_n_per_group
from lapforge.plans.model import SEASON, Model
from lapforge.plans.standings import season_points


def team_order():
    return [F.col("points").desc(), F.col("constructor_id").asc()]


def team_points(m: Model, season: int | None = None) -> DataFrame:
    """Q2 / A1: points per (season, constructor) with the team name."""
    per_team = season_points(m.season_stats(season), ["season", "constructor_id"])
    c = m.constructors().withColumnRenamed("constructor_name", "team")
    return per_team.join(c, "constructor_id", "left") \
        .select("season", "constructor_id", "team", "points")


def points_gap(m: Model) -> DataFrame:
    """Leader, leader points, runner-up points and the gap per season.

    The top two per season come from ``row_number() <= 2`` (partial per-group
    limit); the gap is NULL when a season has one team."""
    top2 = top_n_per_group(team_points(m), ["season"], team_order(), 2)
    return top2.groupBy("season").agg(
        F.max(F.when(F.col("pos") == 1, F.col("constructor_id"))).alias("leader_id"),
        F.max(F.when(F.col("pos") == 1, F.col("points"))).alias("leader_points"),
        F.max(F.when(F.col("pos") == 2, F.col("points"))).alias("second_points"),
    ).withColumn("gap", F.col("leader_points") - F.col("second_points"))


def yoy_delta(m: Model) -> DataFrame:
    """Points minus the constructor's previous present season (first is NULL)."""
    w = Window.partitionBy("constructor_id").orderBy("season")
    t = team_points(m)
    return t.select("constructor_id", "season", "points",
                    (F.col("points") - F.lag("points").over(w)).alias("yoy_delta"))


def constructor_rank(m: Model) -> DataFrame:
    """``rank()`` of constructors in each season by points."""
    w = Window.partitionBy("season").orderBy(F.col("points").desc())
    return team_points(m).select("season", "constructor_id", "points",
                                 F.rank().over(w).alias("rank"))


def team_kpis(m: Model, season: int = SEASON) -> DataFrame:
    """Q10: champion team, its points, number of teams and gap to second."""
    t = team_points(m, season)
    ordered = F.struct(F.col("points"), -F.col("constructor_id"))
    top2 = scalar_row(top_n(t, team_order(), 2)
                      .agg(F.min("points").alias("p2"), F.count(F.lit(1)).alias("n2")))
    head = t.agg(F.max_by("team", ordered).alias("champion"),
                 F.max("points").alias("winning_points"),
                 F.count(F.lit(1)).alias("teams"))
    return head.select(F.lit(season).alias("season"), "champion", "winning_points", "teams",
                       F.when(top2["n2"] > 1, F.col("winning_points") - top2["p2"])
                       .alias("points_gap"))


def top_teams(m: Model, n: int = 5) -> DataFrame:
    """A17 + K4: the ``n`` constructors with most points over all seasons."""
    totals = team_points(m).groupBy("constructor_id") \
        .agg(F.sum("points").cast("bigint").alias("points"))
    return n_largest(totals, "points", "constructor_id", n).select("constructor_id")


def team_trend(m: Model, n: int = 5) -> DataFrame:
    """Q11: season points of the all-time top ``n`` constructors (semi join, no collect)."""
    t = team_points(m)
    return semi_topn(t, "constructor_id", top_teams(m, n)).orderBy("constructor_id", "season")


def season_top_teams(m: Model, season: int = SEASON, n: int = 8) -> DataFrame:
    """Q11 bar: the season's top ``n`` constructors."""
    return top_n(team_points(m, season), team_order(), n)


def team_matrix(m: Model, n: int = 5) -> DataFrame:
    """Q12: constructor x season points matrix of the top ``n`` (absent cell = 0).

    Pivot values are the seasons raced (bounded by the calendar; read from the
    warehouse's season folders), so the pivot is one aggregate without a
    discovery job."""
    seasons = m.season_list()
    t = semi_topn(team_points(m), "constructor_id", top_teams(m, n))
    return pivot_sum(t, ["constructor_id", "team"], "season", "points", seasons)


def era_points(m: Model) -> DataFrame:
    """Q26: points per (rule era, constructor) via the season dimension."""
    seasons = m.seasons()  # one row per calendar year: broadcast is bounded
    t = team_points(m).join(F.broadcast(seasons), F.col("season") == F.col("season_year"))
    return t.groupBy("rule_era", "constructor_id") \
        .agg(F.sum("points").cast("bigint").alias("points"),
             F.count(F.lit(1)).alias("seasons"))


def mart_constructor_trend(m: Model) -> DataFrame:
    """Q23: constructor, season, points, rank in season, change on previous season."""
    t = team_points(m)
    by_season = Window.partitionBy("season").orderBy(F.col("points").desc())
    by_team = Window.partitionBy("constructor_id").orderBy("season")
    return t.select(
        "constructor_id", F.col("team").alias("constructor"), "season",
        F.col("points").alias("pts"),
        F.rank().over(by_season).alias("rank"),
        (F.col("points") - F.lag("points").over(by_team)).alias("yoy_delta"))
