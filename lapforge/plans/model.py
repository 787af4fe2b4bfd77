"""Model frames over the given tables.

The engine's model (race results, drivers, constructors, circuits, seasons,
laps) is mapped onto the TPC-H-style test tables:

* race facts   lineitem joined to orders (season and round from the order date)
* drivers      supplier (a supplier's nation is the driver's constructor)
* constructors nation;  circuits part;  seasons the distinct order years
* laps         events (user = driver, season from the day of month, lap number
               = order of the driver's events in the season)

All frames are lazy; callers select what they need and Catalyst prunes the
scans.  The one big join (lineitem x orders on orderkey) is planned by Spark
(sort-merge at scale, with AQE skew splitting); dimensions join after the
facts are aggregated wherever the grouping key determines the dimension row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.functions import clamp, clean_points, points_of, trunc_int
from lapforge.operators.ordering import sequence_number
from lapforge.sources.tables import read_parquet_table

# Fixed values of the mapping: status text by lineitem return flag.
STATUS_BY_FLAG = {"N": "Finished", "R": "DNF", "A": "+1 Lap"}

# Fixed values of the mapping: which event type carries which sector time.
SECTOR_EVENT = {"sector1": "click", "sector2": "view", "sector3": "purchase"}

# Fixed parameters of the registered queries.
SEASON = 2000
LAP_SEASON = 2024
TREND_DRIVERS = (0, 1, 2)

FACT_COLUMNS = ["race_id", "season", "round", "circuit_id", "driver_id", "finish_position",
                "grid_position", "laps_completed", "points", "status"]
LAP_COLUMNS = ["event_id", "ts", "season", "driver_id", "lap_time", "sector1", "sector2",
               "sector3"]


def rule_era(season) -> "F.Column":
    """Our season dimension attribute (the reference only names the column)."""
    s = F.col(season) if isinstance(season, str) else season
    return (F.when(s < 1996, F.lit("classic"))
            .when(s < 1999, F.lit("transition"))
            .otherwise(F.lit("modern")))


class Model:
    """Lazy model frames for one data directory."""

    def __init__(self, spark: SparkSession, base: str, warehouse: bool = True):
        self.spark = spark
        self.base = base
        self.warehouse = warehouse

    def table(self, name: str, *columns: str) -> DataFrame:
        return read_parquet_table(self.spark, self.base, name, columns or None)

    # ---- facts -------------------------------------------------------------
    def orders_by_season(self, season: int | None = None, with_time: bool = False) -> DataFrame:
        o = self.table("orders", "o_orderkey", "o_orderdate")
        if season is not None:
            # A range on the raw column (not year(...) = s) so parquet can skip row groups.
            lo = _dt.datetime(season, 1, 1)
            hi = _dt.datetime(season + 1, 1, 1)
            o = o.filter((F.col("o_orderdate") >= F.lit(lo)) & (F.col("o_orderdate") < F.lit(hi)))
        return o.select(
            "o_orderkey",
            F.year("o_orderdate").cast("int").alias("season"),
            F.month("o_orderdate").cast("int").alias("round"),
            *(["o_orderdate"] if with_time else []),
        )

    def race_facts(self, season: int | None = None, drivers=None,
                   with_time: bool = False) -> DataFrame:
        """One row per result: race, season, round, circuit, driver, positions, points, status
        (and the race time ``race_ts`` when ``with_time``).

        Read from the warehouse fact (season folders pruned, driver filter
        pushed to parquet) unless the model was built with ``warehouse=False``."""
        if not self.warehouse:
            return self.raw_race_facts(season, drivers, with_time)
        from lapforge.plans import warehouse as wh
        f = wh.season_filter(wh.read_fact(self, wh.FACT_RESULTS), season)
        if drivers is not None:
            f = f.filter(F.col("driver_id").isin(list(drivers)))
        return f.select(*FACT_COLUMNS, *(["race_ts"] if with_time else []))

    def raw_race_facts(self, season: int | None = None, drivers=None,
                       with_time: bool = False) -> DataFrame:
        """The race facts computed from lineitem x orders (what the warehouse stores)."""
        li = self.table("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                        "l_returnflag")
        if drivers is not None:
            li = li.filter(F.col("l_suppkey").isin(list(drivers)))
        o = self.orders_by_season(season, with_time)
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        qty = trunc_int(F.col("l_quantity"))
        pos = F.lit(1) + (qty - F.lit(1)) % F.lit(20)
        status = F.lit(None).cast("string")
        for flag, text in reversed(list(STATUS_BY_FLAG.items())):
            status = F.when(F.col("l_returnflag") == flag, F.lit(text)).otherwise(status)
        return j.select(
            F.col("l_orderkey").alias("race_id"),
            "season",
            "round",
            F.col("l_partkey").alias("circuit_id"),
            F.col("l_suppkey").alias("driver_id"),
            pos.alias("finish_position"),
            clamp(qty, 1, 20).alias("grid_position"),
            qty.alias("laps_completed"),
            points_of(pos).alias("points"),
            status.alias("status"),
            *([F.col("o_orderdate").cast("timestamp").alias("race_ts")] if with_time else []),
        )

    def results(self, season: int | None = None) -> DataFrame:
        """Race facts with the constructor key (the driver's team at the time).

        The warehouse fact stores the key (resolved once at build time)."""
        if not self.warehouse:
            return self.raw_results(season)
        from lapforge.plans import warehouse as wh
        f = wh.season_filter(wh.read_fact(self, wh.FACT_RESULTS), season)
        return f.select(*FACT_COLUMNS, "constructor_id")

    def raw_results(self, season: int | None = None, with_time: bool = False) -> DataFrame:
        """Race facts joined to the supplier for the constructor key."""
        s = self.table("supplier", "s_suppkey", "s_nationkey")
        f = self.raw_race_facts(season, with_time=with_time)
        return f.join(s, f.driver_id == s.s_suppkey, "left").drop("s_suppkey") \
            .withColumnRenamed("s_nationkey", "constructor_id")

    @staticmethod
    def stats_of(results: DataFrame) -> DataFrame:
        """One row per (season, driver, constructor of the fact): the season aggregate."""
        pos = F.col("finish_position")
        return results.groupBy("season", "driver_id", "constructor_id").agg(
            F.sum("points").cast("bigint").alias("points"),
            F.sum(clean_points("finish_position", "points")).cast("bigint").alias("clean_points"),
            F.count(F.lit(1)).alias("races"),
            F.count(pos).alias("position_count"),
            F.sum(pos).cast("bigint").alias("position_sum"),
            F.count_if(pos == 1).alias("wins"),
            F.count_if(pos <= 3).alias("podiums"))

    def season_stats(self, season: int | None = None, drivers=None) -> DataFrame:
        """The season aggregate (``stats_of``), which the warehouse stores."""
        if self.warehouse:
            from lapforge.plans import warehouse as wh
            s = wh.season_filter(wh.read_fact(self, wh.AGG_SEASON), season)
        else:
            s = self.stats_of(self.raw_results(season))
        return s if drivers is None else s.filter(F.col("driver_id").isin(list(drivers)))

    # ---- dimensions ----------------------------------------------------------
    def drivers(self) -> DataFrame:
        s = self.table("supplier", "s_suppkey", "s_name", "s_nationkey")
        return s.select(
            F.col("s_suppkey").alias("driver_id"),
            F.col("s_name").alias("driver_code"),
            F.substring_index("s_name", "#", 1).alias("forename"),
            F.substring_index("s_name", "#", -1).alias("surname"),
            F.col("s_nationkey").alias("constructor_id"),
        )

    def constructors(self) -> DataFrame:
        n = self.table("nation", "n_nationkey", "n_name")
        return n.select(F.col("n_nationkey").alias("constructor_id"),
                        F.col("n_name").alias("constructor_name"))

    def circuits(self) -> DataFrame:
        p = self.table("part", "p_partkey", "p_name", "p_size")
        return p.select(F.col("p_partkey").alias("circuit_id"),
                        F.col("p_name").alias("circuit_name"), "p_size")

    def seasons(self) -> DataFrame:
        """Season dimension: the years raced, with our rule era.  The warehouse
        stores the years at build time."""
        if self.warehouse:
            from lapforge.plans import warehouse as wh
            yr = wh.read_fact(self, wh.DIM_SEASONS)
        else:
            o = self.table("orders", "o_orderdate")
            yr = o.select(F.year("o_orderdate").cast("int").alias("season_year")).distinct()
        return yr.withColumn("rule_era", rule_era("season_year"))

    def season_list(self) -> list[int]:
        """The seasons raced, ascending (bounded by the calendar)."""
        return sorted(r[0] for r in self.seasons().select("season_year").collect()
                      if r[0] is not None)

    # ---- laps ----------------------------------------------------------------
    def laps(self, season: int | None = None, with_lap: bool = False) -> DataFrame:
        """Lap rows: event, time, season, driver, lap time, sectors (and ``lap``)."""
        if not self.warehouse:
            return self.raw_laps(season, with_lap)
        from lapforge.plans import warehouse as wh
        f = wh.season_filter(wh.read_fact(self, wh.FACT_LAPS), season)
        return f.select(*LAP_COLUMNS, *(["lap"] if with_lap else []))

    def raw_laps(self, season: int | None = None, with_lap: bool = False) -> DataFrame:
        """Lap rows computed from events (what the warehouse stores)."""
        e = self.table("events", "event_id", "ts", "user_id", "event_type", "value")
        season_col = (F.lit(2020) + F.floor((F.dayofmonth("ts") - F.lit(1)) / F.lit(6))) \
            .cast("int")
        sectors = [F.when(F.col("event_type") == ev, F.col("value")).alias(name)
                   for name, ev in SECTOR_EVENT.items()]
        laps = e.select(
            "event_id", "ts",
            season_col.alias("season"),
            F.col("user_id").alias("driver_id"),
            F.col("value").alias("lap_time"),
            *sectors,
        )
        if season is not None:
            laps = laps.filter(F.col("season") == season)
        if with_lap:
            laps = sequence_number(laps, ["season", "driver_id"],
                                   [F.col("ts"), F.col("event_id")], name="lap")
        return laps
