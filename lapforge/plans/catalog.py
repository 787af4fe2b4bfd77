"""Registry of the queries exposed to the driver: name -> (Spark query, SQL oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapforge.plans import oracle as O
from lapforge.plans import career as C
from lapforge.plans import laps as L
from lapforge.plans import ops as OP
from lapforge.plans import pipeline as P
from lapforge.plans import quality as Q
from lapforge.plans import standings as S
from lapforge.plans import storage as W
from lapforge.plans import streams as ST
from lapforge.plans import teams as T
from lapforge.plans.common import finalize
from lapforge.plans.model import Model
from lapforge.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Model], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return finalize(fn(Model(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- standings (Q1-Q6, W2, W6) ----------------------------------------------
_REG = [
    ("standings_driver", S.driver_standings, O.SQL_STANDINGS_DRIVER),
    ("standings_team", T.team_points, O.SQL_STANDINGS_TEAM),
    ("season_kpis", S.season_kpis, O.SQL_SEASON_KPIS),
    ("season_top10", S.season_top, O.SQL_SEASON_TOP10),
    ("team_share", S.team_share, O.SQL_TEAM_SHARE),
    ("points_trend", S.points_trend, O.SQL_POINTS_TREND),
    ("rank_ties", S.rank_ties, O.SQL_RANK_TIES),
    ("championships", S.championships, O.SQL_CHAMPIONSHIPS),
    # ---- constructors
    ("points_gap", T.points_gap, O.SQL_POINTS_GAP),
    ("yoy_delta", T.yoy_delta, O.SQL_YOY_DELTA),
    ("constructor_rank", T.constructor_rank, O.SQL_CONSTRUCTOR_RANK),
    ("team_kpis", T.team_kpis, O.SQL_TEAM_KPIS),
    ("team_trend", T.team_trend, O.SQL_TEAM_TREND),
    ("season_top_teams", T.season_top_teams, O.SQL_SEASON_TOP_TEAMS),
    ("team_matrix", T.team_matrix, O.SQL_TEAM_MATRIX),
    ("era_points", T.era_points, O.SQL_ERA_POINTS),
    ("mart_constructor_trend", T.mart_constructor_trend, O.SQL_MART_CONSTRUCTOR_TREND),
    # ---- careers (Q7-Q9, Q21)
    ("career", C.career, O.SQL_CAREER),
    ("career_top8", C.career_top, O.SQL_CAREER_TOP8),
    ("performance_index", C.performance_index, O.SQL_PERFORMANCE_INDEX),
    ("mart_driver_career", C.mart_driver_career, O.SQL_MART_DRIVER_CAREER),
    # ---- laps (Q13-Q17, Q22, Q25)
    ("lap_kpis", L.lap_kpis, O.SQL_LAP_KPIS),
    ("lap_progression", L.lap_progression, O.SQL_LAP_PROGRESSION),
    ("lap_distribution", L.lap_distribution, O.SQL_LAP_DISTRIBUTION),
    ("lap_sketches", L.lap_sketches, O.SQL_LAP_SKETCHES),
    ("lap_histogram", L.lap_histogram, O.SQL_LAP_HISTOGRAM),
    ("sector_means", L.sector_means, O.SQL_SECTOR_MEANS),
    ("consistency", L.consistency, O.SQL_CONSISTENCY),
    ("fuel_adjusted", L.fuel_adjusted, O.SQL_FUEL_ADJUSTED),
    ("mart_lap_performance", L.mart_lap_performance, O.SQL_MART_LAP_PERFORMANCE),
    # ---- pipeline (Q18-Q20, Q24, Q27)
    ("clean_races", P.clean_races, O.SQL_CLEAN_RACES),
    ("transform_results", P.transform_results, O.SQL_TRANSFORM_RESULTS),
    ("mart_season_standings", P.mart_season_standings, O.SQL_MART_SEASON_STANDINGS),
    ("season_aggregates", P.season_aggregates, O.SQL_SEASON_AGGREGATES),
    ("dedup_results", P.dedup_results, O.SQL_DEDUP_RESULTS),
    ("join_driver_constructor", P.join_driver_constructor, O.SQL_JOIN_DRIVER_CONSTRUCTOR),
    ("star_results", P.star_results, O.SQL_STAR_RESULTS),
    # ---- quality (D1-D8) and inventory
    ("dq_report", Q.dq_report, O.SQL_DQ_REPORT),
    ("dq_duplicates", Q.dq_duplicates, O.SQL_DQ_DUPLICATES),
    ("dq_orphans", Q.dq_orphans, O.SQL_DQ_ORPHANS),
    ("dq_schema", Q.dq_schema, O.SQL_DQ_SCHEMA),
    ("table_inventory", Q.table_inventory, O.SQL_TABLE_INVENTORY),
    ("layer_summary", Q.layer_summary, O.SQL_LAYER_SUMMARY),
    # ---- step gaps, series and application log over events
    ("step_gaps", OP.event_gaps, O.SQL_STEP_GAPS),
    ("mean_load_time", OP.event_mean_gap, O.SQL_MEAN_LOAD_TIME),
    ("resource_summary", OP.event_series, O.SQL_RESOURCE_SUMMARY),
    ("app_log", OP.event_log_records, O.SQL_APP_LOG),
    ("log_tail", OP.event_log_tail, O.SQL_LOG_TAIL),
    # ---- run history and stage totals read from texts
    ("run_history", OP.order_run_history, O.SQL_RUN_HISTORY),
    ("stage_totals", OP.order_stage_totals, O.SQL_STAGE_TOTALS),
    # ---- sinks and sources, checked on the stored state
    ("csv_roundtrip", W.csv_roundtrip, O.SQL_CSV_ROUNDTRIP),
    ("merge_mart", W.merge_mart_query, O.SQL_MERGE_MART),
    ("schema_evolution", W.schema_evolution, O.SQL_SCHEMA_EVOLUTION),
    ("append_load", W.append_load, O.SQL_APPEND_LOAD),
    ("catalog_inventory", W.catalog_inventory, O.SQL_CATALOG_INVENTORY),
    ("catalog_results", W.catalog_results, O.SQL_CATALOG_RESULTS),
    # ---- streaming, checked on the final state (S13, ST1, ST2)
    ("land_stream", ST.land_stream_query, O.SQL_LAND_STREAM),
    ("refresh_mart_stream", ST.refresh_mart_stream_query, O.SQL_REFRESH_MART_STREAM),
    ("land_events", ST.land_events_query, O.SQL_LAND_EVENTS),
    ("user_mart_stream", ST.user_mart_query, O.SQL_USER_MART_STREAM),
]

for _name, _fn, _sql in _REG:
    register(_name, _sql)(_fn)
