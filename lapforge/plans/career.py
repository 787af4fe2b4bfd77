"""Driver careers.

The season aggregate sums to races, wins, podiums, points and the mean position per
driver and constructor of the fact; names join the result.  The normalised index divides
by the maxima over all career rows (a one-row aggregate) before the top-3
limit, as the reference does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.functions import full_name, pct, round_even, safe_ratio
from lapforge.operators.aggregates import count_if
from lapforge.operators.joins import with_max
from lapforge.operators.ordering import top_n
from lapforge.plans.model import Model
from lapforge.plans.standings import season_winners


def career_order():
    return [F.col("points").desc(), F.col("driver_id").asc()]


def career_sums(m: Model) -> DataFrame:
    """A2 / A13 per (driver, constructor) from the season aggregate; races counts
    non-NULL positions."""
    return m.season_stats().groupBy("driver_id", "constructor_id").agg(
        F.sum("position_count").cast("bigint").alias("races"),
        F.sum("wins").cast("bigint").alias("wins"),
        F.sum("podiums").cast("bigint").alias("podiums"),
        F.sum("points").cast("bigint").alias("points"),
        F.try_divide(F.sum("position_sum"), F.sum("position_count")).alias("avg_pos"))


def career_stats(facts: DataFrame, keys=("driver_id",)) -> DataFrame:
    """A2: races (non-NULL positions), wins, podiums, points, mean position."""
    pos = F.col("finish_position")
    return facts.groupBy(*keys).agg(
        F.count(pos).alias("races"),
        count_if(pos == 1).alias("wins"),
        count_if(pos <= 3).alias("podiums"),
        F.sum("points").cast("bigint").alias("points"),
        F.avg(pos).alias("avg_pos"),
    )


def career(m: Model) -> DataFrame:
    """Q7: career table; avg position and win % rounded half-to-even to 1 place."""
    stats = career_sums(m)
    d = m.drivers().select("driver_id", F.col("driver_code").alias("code"),
                           full_name("forename", "surname").alias("driver"))
    c = m.constructors().withColumnRenamed("constructor_name", "last_team")
    out = stats.join(d, "driver_id", "left").join(c, "constructor_id", "left")
    return out.select(
        "driver_id", "code", "driver", "last_team", "races", "wins", "podiums", "points",
        round_even("avg_pos", 1).alias("avg_pos"),
        round_even(pct(F.col("wins"), F.col("races")), 1).alias("win_pct"),
    )


def career_top(m: Model, n: int = 8) -> DataFrame:
    """Q8: wins and podiums of the ``n`` drivers with most points (not most wins)."""
    return top_n(career(m), career_order(), n).select("driver_id", "code", "wins", "podiums",
                                                    "points")


INDEX_MEASURES = [("wins", "wins_idx"), ("podiums", "podiums_idx"), ("points", "points_idx"),
                  ("races", "races_idx"), ("win_pct", "win_pct_idx")]


def performance_index(m: Model, n: int = 3) -> DataFrame:
    """Q9: five measures as % of their maximum over all drivers, for the top ``n``."""
    c = career(m)
    withmax = with_max(c, [src for src, _ in INDEX_MEASURES])
    top = top_n(withmax, career_order(), n)
    return top.select(
        "driver_id", "code",
        *[(safe_ratio(F.col(src), F.col("max_" + src)) * F.lit(100.0)).alias(dst)
          for src, dst in INDEX_MEASURES])


def mart_driver_career(m: Model) -> DataFrame:
    """Q21: seasons, races, wins, podiums and championships per driver."""
    # two levels instead of count(distinct season) next to other aggregates
    # (which would expand every row): per (driver, season), then per driver
    per_season = m.season_stats().groupBy("driver_id", "season").agg(
        *(F.sum(c).alias(c) for c in ("races", "wins", "podiums")))
    stats = per_season.groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("seasons"),
        F.sum("races").cast("bigint").alias("races"),
        F.sum("wins").cast("bigint").alias("wins"),
        F.sum("podiums").cast("bigint").alias("podiums"),
    )
    titles = season_winners(m).groupBy("driver_id") \
        .agg(F.count(F.lit(1)).alias("championships"))
    d = m.drivers().select("driver_id", "driver_code")
    out = stats.join(titles, "driver_id", "left").na.fill(0, ["championships"]) \
        .join(d, "driver_id", "left")
    return out.select("driver_id", "driver_code", "seasons", "races", "wins", "podiums",
                      "championships")
