"""Lap-time queries.

Season filter first (one pass over events), then one aggregate per query.
Lap numbers, where needed, come from the distributed ``sequence_number``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.functions import fmt_num, round_even, to_ms
from lapforge.operators.aggregates import distinct_count, distribution, histogram, mean_of
from lapforge.operators.joins import semi_topn
from lapforge.operators.ordering import first_keys
from lapforge.operators.sketches import rank_errors, read_sketches, roll_up, sketch
from lapforge.plans.model import LAP_SEASON, Model
from lapforge.session import scratch_path

FUEL_SLOPE = 0.03  # fixed value: seconds of fuel effect per lap in the reference's model


def lap_kpis(m: Model, season: int = LAP_SEASON, approx_rsd: float | None = None) -> DataFrame:
    """Q13: fastest and mean lap, laps sampled, drivers; with ``%.3f`` text.
    ``approx_rsd`` counts drivers with a HyperLogLog sketch instead."""
    laps = m.laps(season)
    if approx_rsd:
        out = laps.agg(F.min("lap_time").alias("fastest_lap"),
                       F.avg("lap_time").alias("avg_lap"), F.count(F.lit(1)).alias("laps"),
                       distinct_count("driver_id", approx_rsd).alias("drivers"))
    else:
        # exact distinct drivers without expanding every lap row: per driver, then total
        per = laps.groupBy("driver_id").agg(
            F.min("lap_time").alias("mn"), F.sum("lap_time").alias("sm"),
            F.count("lap_time").alias("nv"), F.count(F.lit(1)).alias("n"))
        out = per.agg(F.min("mn").alias("fastest_lap"),
                      F.try_divide(F.sum("sm"), F.sum("nv")).alias("avg_lap"),
                      F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("laps"),
                      F.count("driver_id").alias("drivers"))
    return out.select(F.lit(season).alias("season"), "fastest_lap", "avg_lap", "laps", "drivers",
                      fmt_num("fastest_lap", 3).alias("fastest_txt"),
                      fmt_num("avg_lap", 3).alias("avg_txt"))


def lap_progression(m: Model, season: int = LAP_SEASON, n: int = 5) -> DataFrame:
    """Q14: lap time by lap for the first ``n`` drivers (by key) of the season."""
    laps = m.laps(season, with_lap=True)
    first = first_keys(laps, "driver_id", n)
    return semi_topn(laps, "driver_id", first).select("driver_id", "lap", "lap_time") \
        .orderBy("driver_id", "lap")


def lap_distribution(m: Model, season: int = LAP_SEASON,
                     approx_accuracy: int | None = None) -> DataFrame:
    """Q15: per driver count, min, quartiles (linear interpolation), max, mean."""
    return distribution(m.laps(season), ["driver_id"], "lap_time", approx_accuracy)


def lap_histogram(m: Model, season: int = LAP_SEASON, bins: int = 10) -> DataFrame:
    """Q15 density: laps per equal-width bucket of the season's range, per driver."""
    return histogram(m.laps(season), ["driver_id"], "lap_time", bins)


def sector_means(m: Model, season: int = LAP_SEASON) -> DataFrame:
    """Q16: mean sector times per driver (NULL sectors skipped)."""
    return mean_of(m.laps(season), ["driver_id"], ["sector1", "sector2", "sector3"])


def consistency(m: Model, season: int = LAP_SEASON) -> DataFrame:
    """Q17: sample standard deviation of lap time per driver, ascending."""
    s = m.laps(season).groupBy("driver_id").agg(F.stddev_samp("lap_time").alias("std_dev"))
    return s.select("driver_id", "std_dev", round_even("std_dev", 3).alias("std_dev_3")) \
        .orderBy("std_dev", "driver_id")


def fuel_adjusted(m: Model, season: int = LAP_SEASON, slope: float = FUEL_SLOPE) -> DataFrame:
    """Q25: mean of lap_time + slope x lap (fuel burn correction) per driver."""
    laps = m.laps(season, with_lap=True)
    adj = F.col("lap_time") + F.lit(slope) * F.col("lap")
    return laps.groupBy("driver_id").agg(F.avg(adj).alias("fuel_adjusted_pace"),
                                         F.avg("lap_time").alias("raw_pace"),
                                         F.count(F.lit(1)).alias("laps"))


def mart_lap_performance(m: Model) -> DataFrame:
    """Q22: per driver and race (a season's laps): mean and fastest lap in ms and
    consistency % = 100 x (1 - stddev / mean) (NULL with one lap)."""
    laps = m.laps()
    ms = to_ms(F.col("lap_time"))
    g = laps.groupBy("driver_id", F.col("season").alias("race")).agg(
        F.avg(ms).alias("avg_lap_ms"), F.min(ms).alias("fastest_lap_ms"),
        F.stddev_samp("lap_time").alias("_sd"), F.avg("lap_time").alias("_mean"),
        F.count(F.lit(1)).alias("laps"))
    return g.select("driver_id", "race", "avg_lap_ms", "fastest_lap_ms", "laps",
                    (F.lit(100.0) * (F.lit(1.0) - F.try_divide(F.col("_sd"), F.col("_mean"))))
                    .alias("consistency_pct"))


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
RANK_BOUND, DISTINCT_BOUND = 0.03, 0.08  # twice the 99 % bound of KLL, five standard errors of HyperLogLog


def lap_sketch_mart(m: Model) -> str:
    """The sketches of lap times and drivers per (season, day), written as a mart table."""
    path = scratch_path(m.spark, "agg_lap_sketches")
    days = m.laps().select("season", F.to_date("ts").alias("day"), "lap_time", "driver_id")
    sketch(days, ["season", "day"], "lap_time", "driver_id").write.partitionBy("season").parquet(path)
    return path


def lap_sketches(m: Model) -> DataFrame:
    """A10 / A15 from sketches: per season the laps, and whether quartiles and drivers read from
    the merged sketches of its days keep their bounds against the laps themselves."""
    names, probs = list(QUARTILES), list(QUARTILES.values())
    read = read_sketches(roll_up(m.spark.read.parquet(lap_sketch_mart(m)), ["season"]), ["season"], probs, names)
    read = read.checkpoint()  # a merged sketch is random within its bound: one result for all that follows
    errors = rank_errors(m.laps(), ["season"], "lap_time", read, probs, names)
    exact = m.laps().select("season", "driver_id").distinct().groupBy("season").agg(F.count("driver_id").alias("drivers"))
    off = F.abs(F.col("distinct") - F.col("drivers")) / F.col("drivers")
    return read.drop(*names).join(errors, "season").join(exact, "season").select(
        "season", F.col("rows").alias("laps"), "values", "drivers", (off <= DISTINCT_BOUND).alias("drivers_ok"),
        *((F.col(c) <= RANK_BOUND).alias(f"{c}_ok") for c in names))
