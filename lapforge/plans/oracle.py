"""Independent SQL for every registered query, as DuckDB runs it on the same
parquet tables (views ``lineitem``, ``orders``, ``supplier``, ``nation``,
``part``, ``events`` ...).

The model mapping is written out again in SQL (not generated from the Spark
code), so a mapping mistake on one side shows up as a mismatch.  ``out()``
types the final columns the way ``plans.common.finalize`` does on the Spark
side: integers BIGINT, fractions DOUBLE rounded half-to-even to 6 places.
"""

from __future__ import annotations

_QTY = "CAST(trunc(l.l_quantity) AS INTEGER)"
_POS = f"(1 + ({_QTY} - 1) % 20)"

# Fixed values (same table as lapforge.functions.POINTS_BY_POSITION).
_POINTS_CASE = (f"CASE {_POS} WHEN 1 THEN 25 WHEN 2 THEN 18 WHEN 3 THEN 15 WHEN 4 THEN 12 "
                "WHEN 5 THEN 10 WHEN 6 THEN 8 WHEN 7 THEN 6 WHEN 8 THEN 4 WHEN 9 THEN 2 "
                "WHEN 10 THEN 1 ELSE 0 END")

FACTS = f"""facts AS (
  SELECT l.l_orderkey AS race_id,
         CAST(year(o.o_orderdate) AS INTEGER) AS season,
         CAST(month(o.o_orderdate) AS INTEGER) AS round,
         l.l_partkey AS circuit_id,
         l.l_suppkey AS driver_id,
         {_POS} AS finish_position,
         greatest(1, least(20, {_QTY})) AS grid_position,
         {_QTY} AS laps_completed,
         {_POINTS_CASE} AS points,
         CASE l.l_returnflag WHEN 'N' THEN 'Finished' WHEN 'R' THEN 'DNF'
              WHEN 'A' THEN '+1 Lap' END AS status
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

RESULTS = """results AS (
  SELECT f.*, s.s_nationkey AS constructor_id
  FROM facts f LEFT JOIN supplier s ON f.driver_id = s.s_suppkey)"""

DRIVERS = """drivers AS (
  SELECT s_suppkey AS driver_id, s_name AS driver_code,
         split_part(s_name, '#', 1) AS forename, split_part(s_name, '#', 2) AS surname,
         s_nationkey AS constructor_id
  FROM supplier)"""

CONSTRUCTORS = """constructors AS (
  SELECT n_nationkey AS constructor_id, n_name AS constructor_name FROM nation)"""

STANDINGS = """standings AS (
  SELECT p.season, p.driver_id, d.driver_code, d.forename || ' ' || d.surname AS driver_name,
         d.constructor_id, c.constructor_name AS team, p.points
  FROM (SELECT season, driver_id, SUM(points) AS points FROM facts GROUP BY season, driver_id) p
  LEFT JOIN drivers d ON p.driver_id = d.driver_id
  LEFT JOIN constructors c ON d.constructor_id = c.constructor_id)"""

RANKED = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY points DESC, driver_id) AS rank
  FROM standings)"""

TEAMS = """teams AS (
  SELECT r.season, r.constructor_id, c.constructor_name AS team, SUM(r.points) AS points
  FROM results r LEFT JOIN constructors c ON r.constructor_id = c.constructor_id
  GROUP BY r.season, r.constructor_id, c.constructor_name)"""

CAREER = """career AS (
  SELECT p.driver_id, d.driver_code AS code, d.forename || ' ' || d.surname AS driver,
         c.constructor_name AS last_team, p.races, p.wins, p.podiums, p.points,
         round_even(p.avg_pos, 1) AS avg_pos,
         round_even(CAST(p.wins AS DOUBLE) / p.races * 100, 1) AS win_pct
  FROM (SELECT driver_id, count(finish_position) AS races,
               count_if(finish_position = 1) AS wins,
               count_if(finish_position <= 3) AS podiums,
               SUM(points) AS points, avg(finish_position) AS avg_pos
        FROM facts GROUP BY driver_id) p
  LEFT JOIN drivers d ON p.driver_id = d.driver_id
  LEFT JOIN constructors c ON d.constructor_id = c.constructor_id)"""

LAPS = """laps AS (
  SELECT event_id, ts, CAST(2020 + (day(ts) - 1) // 6 AS INTEGER) AS season,
         user_id AS driver_id, value AS lap_time,
         CASE WHEN event_type = 'click' THEN value END AS sector1,
         CASE WHEN event_type = 'view' THEN value END AS sector2,
         CASE WHEN event_type = 'purchase' THEN value END AS sector3
  FROM events)"""

LAPS_N = """laps_n AS (
  SELECT *, row_number() OVER (PARTITION BY season, driver_id ORDER BY ts, event_id) AS lap
  FROM laps)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def out(spec: str, body: str) -> str:
    """Wrap ``body`` so its columns get the shared output types.

    ``spec`` is ``"name:kind ..."`` with kind ``i`` (BIGINT), ``d`` (DOUBLE, 6
    places half-even), ``s`` (VARCHAR).
    """
    cols = []
    for item in spec.split():
        name, kind = item.rsplit(":", 1)
        q = f'"{name}"'
        if kind == "i":
            cols.append(f"CAST({q} AS BIGINT) AS {q}")
        elif kind == "d":
            cols.append(f"round_even(CAST({q} AS DOUBLE), 6) AS {q}")
        else:
            cols.append(f"CAST({q} AS VARCHAR) AS {q}")
    return f"SELECT {', '.join(cols)} FROM (\n{body}\n) q"


STANDINGS_SPEC = ("season:i driver_id:i driver_code:s driver_name:s constructor_id:i "
                  "team:s points:i rank:i")

# ---- standings --------------------------------------------------------------
_STD = with_(FACTS, DRIVERS, CONSTRUCTORS, STANDINGS, RANKED)

SQL_STANDINGS_DRIVER = out(STANDINGS_SPEC, _STD + "SELECT * FROM ranked")

SQL_STANDINGS_TEAM = out("season:i constructor_id:i team:s points:i",
                         with_(FACTS, RESULTS, CONSTRUCTORS, TEAMS) + "SELECT * FROM teams")

SQL_SEASON_KPIS = out(
    "season:i champion:s champion_points:i drivers:i constructors:i",
    _STD + """SELECT 2000 AS season,
       max(CASE WHEN rank = 1 THEN driver_code END) AS champion,
       max(CASE WHEN rank = 1 THEN points END) AS champion_points,
       count(*) AS drivers, count(DISTINCT team) AS constructors
FROM ranked WHERE season = 2000""")

SQL_SEASON_TOP10 = out(STANDINGS_SPEC, _STD + "SELECT * FROM ranked WHERE season = 2000 AND rank <= 10")

SQL_TEAM_SHARE = out("constructor_id:i team:s points:i share:d", with_(
    FACTS, DRIVERS, CONSTRUCTORS, STANDINGS) + """,
top AS (SELECT constructor_id, team, SUM(points) AS points FROM standings WHERE season = 2000
        GROUP BY constructor_id, team ORDER BY points DESC, constructor_id LIMIT 6)
SELECT constructor_id, team, points, points / SUM(points) OVER () AS share FROM top""")

SQL_POINTS_TREND = out("driver_id:i driver_code:s season:i points:i", with_(
    FACTS, DRIVERS, CONSTRUCTORS, STANDINGS)
    + "SELECT driver_id, driver_code, season, points FROM standings WHERE driver_id IN (0, 1, 2)")

SQL_RANK_TIES = out("season:i driver_id:i points:i rank_min:i", with_(
    FACTS, DRIVERS, CONSTRUCTORS, STANDINGS) + """SELECT season, driver_id, points,
       rank() OVER (PARTITION BY season ORDER BY points DESC) AS rank_min FROM standings""")

SQL_CHAMPIONSHIPS = out("driver_id:i championships:i", _STD + """SELECT d.driver_id,
       count(w.season) AS championships
FROM (SELECT DISTINCT driver_id FROM facts) d
LEFT JOIN (SELECT season, driver_id FROM ranked WHERE rank = 1) w ON d.driver_id = w.driver_id
GROUP BY d.driver_id""")

# ---- teams ------------------------------------------------------------------
_TEAMS = with_(FACTS, RESULTS, CONSTRUCTORS, TEAMS)

SQL_POINTS_GAP = out("season:i leader_id:i leader_points:i second_points:i gap:i", _TEAMS + """,
p AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY points DESC, constructor_id) AS pos
      FROM teams)
SELECT season, max(CASE WHEN pos = 1 THEN constructor_id END) AS leader_id,
       max(CASE WHEN pos = 1 THEN points END) AS leader_points,
       max(CASE WHEN pos = 2 THEN points END) AS second_points,
       max(CASE WHEN pos = 1 THEN points END) - max(CASE WHEN pos = 2 THEN points END) AS gap
FROM p GROUP BY season""")

SQL_YOY_DELTA = out("constructor_id:i season:i points:i yoy_delta:i", _TEAMS + """SELECT
  constructor_id, season, points,
  points - lag(points) OVER (PARTITION BY constructor_id ORDER BY season) AS yoy_delta
FROM teams""")

SQL_CONSTRUCTOR_RANK = out("season:i constructor_id:i points:i rank:i", _TEAMS + """SELECT
  season, constructor_id, points, rank() OVER (PARTITION BY season ORDER BY points DESC) AS rank
FROM teams""")

SQL_TEAM_KPIS = out("season:i champion:s winning_points:i teams:i points_gap:i", _TEAMS + """,
p AS (SELECT *, row_number() OVER (ORDER BY points DESC, constructor_id) AS pos
      FROM teams WHERE season = 2000)
SELECT 2000 AS season, max(CASE WHEN pos = 1 THEN team END) AS champion,
       max(points) AS winning_points, count(*) AS teams,
       max(CASE WHEN pos = 1 THEN points END) - max(CASE WHEN pos = 2 THEN points END) AS points_gap
FROM p""")

_TOP5 = """,
top5 AS (SELECT constructor_id FROM teams GROUP BY constructor_id
         ORDER BY SUM(points) DESC, constructor_id LIMIT 5)
"""

SQL_TEAM_TREND = out("season:i constructor_id:i team:s points:i", _TEAMS + _TOP5
                     + "SELECT * FROM teams WHERE constructor_id IN (SELECT constructor_id FROM top5)")

SQL_SEASON_TOP_TEAMS = out("season:i constructor_id:i team:s points:i", _TEAMS + """SELECT *
FROM teams WHERE season = 2000 ORDER BY points DESC, constructor_id LIMIT 8""")

# Seasons present in the test data (1995-2001); the Spark side reads them from
# the season dimension.
MATRIX_SEASONS = list(range(1995, 2002))
SQL_TEAM_MATRIX = out(
    "constructor_id:i team:s " + " ".join(f"{s}:i" for s in MATRIX_SEASONS),
    _TEAMS + _TOP5 + "SELECT constructor_id, team, "
    + ", ".join(f'coalesce(SUM(CASE WHEN season = {s} THEN points END), 0) AS "{s}"'
                for s in MATRIX_SEASONS)
    + " FROM teams WHERE constructor_id IN (SELECT constructor_id FROM top5)"
      " GROUP BY constructor_id, team")

SQL_ERA_POINTS = out("rule_era:s constructor_id:i points:i seasons:i", _TEAMS + """SELECT
  CASE WHEN season < 1996 THEN 'classic' WHEN season < 1999 THEN 'transition' ELSE 'modern' END
    AS rule_era,
  constructor_id, SUM(points) AS points, count(*) AS seasons
FROM teams GROUP BY 1, 2""")

SQL_MART_CONSTRUCTOR_TREND = out(
    "constructor_id:i constructor:s season:i pts:i rank:i yoy_delta:i", _TEAMS + """SELECT
  constructor_id, team AS constructor, season, points AS pts,
  rank() OVER (PARTITION BY season ORDER BY points DESC) AS rank,
  points - lag(points) OVER (PARTITION BY constructor_id ORDER BY season) AS yoy_delta
FROM teams""")

# ---- career -------------------------------------------------------------------
_CAREER = with_(FACTS, DRIVERS, CONSTRUCTORS, CAREER)

SQL_CAREER = out("driver_id:i code:s driver:s last_team:s races:i wins:i podiums:i points:i "
                 "avg_pos:d win_pct:d", _CAREER + "SELECT * FROM career")

SQL_CAREER_TOP8 = out("driver_id:i code:s wins:i podiums:i points:i", _CAREER + """SELECT
  driver_id, code, wins, podiums, points FROM career ORDER BY points DESC, driver_id LIMIT 8""")

SQL_PERFORMANCE_INDEX = out(
    "driver_id:i code:s wins_idx:d podiums_idx:d points_idx:d races_idx:d win_pct_idx:d",
    _CAREER + """,
mx AS (SELECT max(wins) AS mw, max(podiums) AS mp, max(points) AS mpt, max(races) AS mr,
              max(win_pct) AS mwp FROM career)
SELECT driver_id, code,
  coalesce(wins / nullif(mw, 0), 0) * 100 AS wins_idx,
  coalesce(podiums / nullif(mp, 0), 0) * 100 AS podiums_idx,
  coalesce(points / nullif(mpt, 0), 0) * 100 AS points_idx,
  coalesce(races / nullif(mr, 0), 0) * 100 AS races_idx,
  coalesce(win_pct / nullif(mwp, 0), 0) * 100 AS win_pct_idx
FROM career, mx ORDER BY points DESC, driver_id LIMIT 3""")

SQL_MART_DRIVER_CAREER = out(
    "driver_id:i driver_code:s seasons:i races:i wins:i podiums:i championships:i", _STD + """,
w AS (SELECT driver_id, count(*) AS championships FROM ranked WHERE rank = 1 GROUP BY driver_id)
SELECT f.driver_id, d.driver_code, f.seasons, f.races, f.wins, f.podiums,
       coalesce(w.championships, 0) AS championships
FROM (SELECT driver_id, count(DISTINCT season) AS seasons, count(*) AS races,
             count_if(finish_position = 1) AS wins, count_if(finish_position <= 3) AS podiums
      FROM facts GROUP BY driver_id) f
LEFT JOIN w ON f.driver_id = w.driver_id
LEFT JOIN drivers d ON f.driver_id = d.driver_id""")

# ---- laps ---------------------------------------------------------------------
_LAPS = with_(LAPS)

SQL_LAP_KPIS = out("season:i fastest_lap:d avg_lap:d laps:i drivers:i fastest_txt:s avg_txt:s",
                   _LAPS + """SELECT 2024 AS season, min(lap_time) AS fastest_lap,
  avg(lap_time) AS avg_lap, count(*) AS laps, count(DISTINCT driver_id) AS drivers,
  printf('%.3f', min(lap_time)) AS fastest_txt, printf('%.3f', avg(lap_time)) AS avg_txt
FROM laps WHERE season = 2024""")

SQL_LAP_PROGRESSION = out("driver_id:i lap:i lap_time:d", with_(LAPS, LAPS_N) + """SELECT
  driver_id, lap, lap_time FROM laps_n WHERE season = 2024 AND driver_id IN (
    SELECT DISTINCT driver_id FROM laps WHERE season = 2024 ORDER BY driver_id LIMIT 5)""")

SQL_LAP_DISTRIBUTION = out("driver_id:i n:i min:d mean:d max:d q1:d median:d q3:d",
                           _LAPS + """SELECT driver_id, count(lap_time) AS n, min(lap_time) AS min,
  avg(lap_time) AS mean, max(lap_time) AS max,
  quantile_cont(lap_time, 0.25) AS q1, quantile_cont(lap_time, 0.5) AS median,
  quantile_cont(lap_time, 0.75) AS q3
FROM laps WHERE season = 2024 GROUP BY driver_id""")

SQL_LAP_HISTOGRAM = out("driver_id:i bucket:i laps:i", _LAPS + """,
s AS (SELECT * FROM laps WHERE season = 2024 AND lap_time IS NOT NULL),
b AS (SELECT min(lap_time) AS lo, max(lap_time) AS hi FROM s)
SELECT driver_id,
  least(10, CAST(floor(coalesce((lap_time - lo) / nullif(hi - lo, 0), 0) * 10.0) AS BIGINT) + 1)
    AS bucket,
  count(*) AS laps
FROM s, b GROUP BY 1, 2""")

SQL_SECTOR_MEANS = out("driver_id:i sector1:d sector2:d sector3:d", _LAPS + """SELECT driver_id,
  avg(sector1) AS sector1, avg(sector2) AS sector2, avg(sector3) AS sector3
FROM laps WHERE season = 2024 GROUP BY driver_id""")

SQL_CONSISTENCY = out("driver_id:i std_dev:d std_dev_3:d", _LAPS + """SELECT driver_id,
  stddev_samp(lap_time) AS std_dev, round_even(stddev_samp(lap_time), 3) AS std_dev_3
FROM laps WHERE season = 2024 GROUP BY driver_id""")

SQL_FUEL_ADJUSTED = out("driver_id:i fuel_adjusted_pace:d raw_pace:d laps:i",
                        with_(LAPS, LAPS_N) + """SELECT driver_id,
  avg(lap_time + 0.03 * lap) AS fuel_adjusted_pace, avg(lap_time) AS raw_pace, count(*) AS laps
FROM laps_n WHERE season = 2024 GROUP BY driver_id""")

SQL_MART_LAP_PERFORMANCE = out(
    "driver_id:i race:i avg_lap_ms:d fastest_lap_ms:i laps:i consistency_pct:d", _LAPS + """SELECT
  driver_id, season AS race,
  avg(CAST(round_even(lap_time * 1000.0, 0) AS BIGINT)) AS avg_lap_ms,
  min(CAST(round_even(lap_time * 1000.0, 0) AS BIGINT)) AS fastest_lap_ms,
  count(*) AS laps,
  100.0 * (1.0 - stddev_samp(lap_time) / avg(lap_time)) AS consistency_pct
FROM laps GROUP BY driver_id, season""")

# ---- pipeline -----------------------------------------------------------------
SQL_CLEAN_RACES = out("race_id:i season:i round:i race_date:s name:s", """SELECT
  o_orderkey AS race_id, year(o_orderdate) AS season, month(o_orderdate) AS round,
  strftime(o_orderdate, '%Y-%m-%d') AS race_date, trim(o_orderpriority) AS name
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
  AND year(o_orderdate) BETWEEN 1950 AND 2024""")

SQL_TRANSFORM_RESULTS = out(
    "season:i driver_id:i code:s constructor_id:i total_points:i position_count:i season_rank:i",
    with_(FACTS, RESULTS, DRIVERS) + """,
a AS (SELECT r.season, r.driver_id, d.driver_code AS code, r.constructor_id,
             SUM(CASE WHEN r.finish_position IN (1,2,3,4,5,6,7,8,9,10) THEN r.points ELSE 0 END)
               AS total_points,
             count(r.finish_position) AS position_count
      FROM results r LEFT JOIN drivers d ON r.driver_id = d.driver_id
      GROUP BY 1, 2, 3, 4)
SELECT *, rank() OVER (PARTITION BY season ORDER BY total_points DESC) AS season_rank FROM a""")

SQL_MART_SEASON_STANDINGS = out(
    "season:i driver_id:i driver_code:s driver_name:s constructor_id:i constructor_name:s "
    "total_points:i total_races:i wins:i podiums:i season_rank:i",
    with_(FACTS, RESULTS, DRIVERS, CONSTRUCTORS) + """,
base AS (
  SELECT r.season, r.driver_id, d.driver_code, d.forename || ' ' || d.surname AS driver_name,
         r.constructor_id, c.constructor_name,
         SUM(r.points) AS total_points, COUNT(*) AS total_races,
         count_if(r.finish_position = 1) AS wins, count_if(r.finish_position <= 3) AS podiums
  FROM results r JOIN drivers d USING (driver_id) JOIN constructors c
    ON r.constructor_id = c.constructor_id
  GROUP BY 1, 2, 3, 4, 5, 6)
SELECT *, rank() OVER (PARTITION BY season ORDER BY total_points DESC) AS season_rank FROM base""")

SQL_SEASON_AGGREGATES = out("driver_id:i season:i points:i prev_points:i delta:i",
                            with_(FACTS) + """,
s AS (SELECT season, driver_id, SUM(points) AS points FROM facts GROUP BY 1, 2)
SELECT driver_id, season, points,
  lag(points) OVER (PARTITION BY driver_id ORDER BY season) AS prev_points,
  points - lag(points) OVER (PARTITION BY driver_id ORDER BY season) AS delta
FROM s""")

SQL_DEDUP_RESULTS = out(
    "race_id:i season:i round:i circuit_id:i driver_id:i finish_position:i grid_position:i "
    "laps_completed:i points:i status:s", with_(FACTS) + """SELECT
  race_id, season, round, circuit_id, driver_id, finish_position, grid_position, laps_completed,
  points, status
FROM (SELECT *, row_number() OVER (PARTITION BY race_id, driver_id ORDER BY season, round,
        circuit_id, finish_position, grid_position, laps_completed, points, status) AS rn
      FROM facts) WHERE rn = 1""")

# ---- quality ------------------------------------------------------------------
_P_OF_POS = ("CASE finish_position WHEN 1 THEN 25 WHEN 2 THEN 18 WHEN 3 THEN 15 WHEN 4 THEN 12 "
             "WHEN 5 THEN 10 WHEN 6 THEN 8 WHEN 7 THEN 6 WHEN 8 THEN 4 WHEN 9 THEN 2 "
             "WHEN 10 THEN 1 ELSE 0 END")

_DQ_FINISH = """SELECT "table", "check", violations, total,
  100.0 * (total - violations) / total AS pass_pct,
  CASE WHEN violations = 0 THEN 'pass'
       WHEN 100.0 * (total - violations) / total >= 99.0 THEN 'warn' ELSE 'fail' END AS status
FROM checks"""

SQL_DQ_REPORT = out("table:s check:s violations:i total:i pass_pct:d status:s",
                    with_(FACTS, RESULTS, LAPS) + f""",
r AS (SELECT count(*) AS total,
        count_if(driver_id IS NULL) AS d1,
        count_if(NOT coalesce(finish_position BETWEEN 1 AND 20, false)) AS d2,
        count_if(points IS DISTINCT FROM ({_P_OF_POS})) AS d3,
        count_if(NOT coalesce(season BETWEEN 1950 AND 2024, false)) AS d6
      FROM results),
l AS (SELECT count(*) AS total, count_if(NOT coalesce(lap_time > 60, false)) AS d4 FROM laps),
checks AS (
  SELECT 'fact_race_results' AS "table", 'not_null:driver_id' AS "check", d1 AS violations, total FROM r
  UNION ALL SELECT 'fact_race_results', 'in_range:finish_position[1,20]', d2, total FROM r
  UNION ALL SELECT 'fact_race_results', 'matches_map:points~finish_position', d3, total FROM r
  UNION ALL SELECT 'fact_race_results', 'in_range:season[1950,2024]', d6, total FROM r
  UNION ALL SELECT 'fact_lap_times', 'greater_than:lap_time>60', d4, total FROM l)
""" + _DQ_FINISH)

SQL_DQ_DUPLICATES = out("key_groups:i dup_groups:i dup_rows:i status:s", with_(FACTS) + """,
g AS (SELECT race_id, driver_id, count(*) AS n FROM facts GROUP BY 1, 2)
SELECT count(*) AS key_groups, count_if(n > 1) AS dup_groups,
  coalesce(SUM(CASE WHEN n > 1 THEN n END), 0) AS dup_rows,
  CASE WHEN count_if(n > 1) = 0 THEN 'pass' ELSE 'fail' END AS status
FROM g""")

SQL_DQ_ORPHANS = out("check:s violations:i total:i pass_pct:d status:s",
                     with_(FACTS, RESULTS) + """,
c AS (
  SELECT 'fk:constructor_id->dim_constructors' AS "check", count(*) AS total,
         count_if(constructor_id NOT IN (SELECT n_nationkey FROM nation) OR constructor_id IS NULL)
           AS violations
  FROM results
  UNION ALL
  SELECT 'fk:circuit_id->dim_circuits', count(*),
         count_if(circuit_id NOT IN (SELECT p_partkey FROM part)
                  OR circuit_id IS NULL)
  FROM results),
checks AS (SELECT NULL AS "table", * FROM c)
SELECT "check", violations, total, 100.0 * (total - violations) / total AS pass_pct,
  CASE WHEN violations = 0 THEN 'pass'
       WHEN 100.0 * (total - violations) / total >= 99.0 THEN 'warn' ELSE 'fail' END AS status
FROM checks""")

SQL_TABLE_INVENTORY = out(
    "table:s layer:s rows:i grain:s distinct_grain:i grain_unique:i",
    with_(FACTS, RESULTS, LAPS) + """
SELECT 'fact_race_results' AS "table", 'fact' AS layer, count(*) AS rows,
  'race_id + driver_id' AS grain, count(DISTINCT (race_id, driver_id)) AS distinct_grain,
  CAST(count(*) = count(DISTINCT (race_id, driver_id)) AS BIGINT) AS grain_unique FROM facts
UNION ALL SELECT 'fact_lap_times', 'fact', count(*), 'season + driver_id + event_id',
  count(DISTINCT (season, driver_id, event_id)),
  CAST(count(*) = count(DISTINCT (season, driver_id, event_id)) AS BIGINT) FROM laps
UNION ALL SELECT 'dim_drivers', 'dimension', count(*), 'driver_id', count(DISTINCT s_suppkey),
  CAST(count(*) = count(DISTINCT s_suppkey) AS BIGINT) FROM supplier
UNION ALL SELECT 'dim_constructors', 'dimension', count(*), 'constructor_id',
  count(DISTINCT n_nationkey), CAST(count(*) = count(DISTINCT n_nationkey) AS BIGINT) FROM nation
UNION ALL SELECT 'dim_circuits', 'dimension', count(*), 'circuit_id', count(DISTINCT p_partkey),
  CAST(count(*) = count(DISTINCT p_partkey) AS BIGINT) FROM part
UNION ALL SELECT 'agg_season_points', 'mart', count(*), 'season + driver_id', count(*), 1
  FROM (SELECT DISTINCT season, driver_id FROM facts)
UNION ALL SELECT 'agg_constructor_pts', 'mart', count(*), 'season + constructor_id', count(*), 1
  FROM (SELECT DISTINCT season, constructor_id FROM results)""")

# ---- storage round trips ----------------------------------------------------------
SQL_CSV_ROUNDTRIP = out("season:i driver_id:i driver_code:s points:i", with_(
    FACTS, DRIVERS, CONSTRUCTORS, STANDINGS)
    + "SELECT season, driver_id, driver_code, points FROM standings")

SQL_MERGE_MART = SQL_MART_SEASON_STANDINGS

SQL_SCHEMA_EVOLUTION = out("season:i driver_id:i points:i wins:i", with_(FACTS) + """SELECT
  season, driver_id, SUM(points) AS points,
  CASE WHEN season >= 1999 THEN count_if(finish_position = 1) END AS wins
FROM facts GROUP BY season, driver_id""")

SQL_APPEND_LOAD = out("season:i driver_id:i points:i rows_loaded:i", with_(FACTS) + """,
s AS (SELECT season, driver_id, SUM(points) AS points FROM facts GROUP BY season, driver_id)
SELECT season, driver_id, points, (SELECT count(*) FROM s) AS rows_loaded FROM s""")

# ---- streaming (final state) ------------------------------------------------------
_DISTINCT_RAW = f"""raw AS (
  SELECT DISTINCT l.l_orderkey AS race_id, CAST(year(o.o_orderdate) AS INTEGER) AS season,
         CAST(month(o.o_orderdate) AS INTEGER) AS round, l.l_partkey AS circuit_id,
         l.l_suppkey AS driver_id, {_POS} AS finish_position, {_POINTS_CASE} AS points,
         CASE l.l_returnflag WHEN 'N' THEN 'Finished' WHEN 'R' THEN 'DNF'
              WHEN 'A' THEN '+1 Lap' END AS status,
         strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS race_ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

SQL_LAND_STREAM = out("race_id:i season:i round:i circuit_id:i driver_id:i finish_position:i "
                      "points:i status:s race_ts:s", with_(_DISTINCT_RAW) + "SELECT * FROM raw")

SQL_REFRESH_MART_STREAM = out("season:i driver_id:i points:i races:i wins:i",
                              with_(_DISTINCT_RAW) + """SELECT season, driver_id,
  SUM(points) AS points, count(*) AS races, count_if(finish_position = 1) AS wins
FROM raw GROUP BY season, driver_id""")

# ---- joins and the engine's own run log ----------------------------------------
SQL_JOIN_DRIVER_CONSTRUCTOR = out(
    "race_id:i season:i driver_id:i driver_code:s driver_name:s constructor_id:i "
    "constructor_name:s finish_position:i points:i", with_(FACTS, RESULTS, DRIVERS, CONSTRUCTORS)
    + """SELECT r.race_id, r.season, r.driver_id, d.driver_code,
  d.forename || ' ' || d.surname AS driver_name, r.constructor_id, c.constructor_name,
  r.finish_position, r.points
FROM results r LEFT JOIN drivers d ON r.driver_id = d.driver_id
LEFT JOIN constructors c ON r.constructor_id = c.constructor_id""")

SQL_STAR_RESULTS = out(
    "race_id:i season:i rule_era:s circuit_id:i circuit_name:s driver_id:i driver_code:s "
    "constructor_name:s finish_position:i points:i",
    with_(FACTS, RESULTS, DRIVERS, CONSTRUCTORS) + """SELECT r.race_id, r.season,
  CASE WHEN r.season < 1996 THEN 'classic' WHEN r.season < 1999 THEN 'transition'
       ELSE 'modern' END AS rule_era,
  r.circuit_id, p.p_name AS circuit_name, r.driver_id, d.driver_code, c.constructor_name,
  r.finish_position, r.points
FROM results r JOIN part p ON r.circuit_id = p.p_partkey
JOIN drivers d ON r.driver_id = d.driver_id
JOIN (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season FROM orders) s
  ON r.season = s.season
JOIN constructors c ON r.constructor_id = c.constructor_id""")

SQL_LAYER_SUMMARY = out("layer:s rows:i tables:i failures:i raw_rows_loaded:i",
                        with_(FACTS, RESULTS, LAPS) + """,
log AS (
  SELECT 'raw' AS layer, count(*) AS rows FROM lineitem
  UNION ALL SELECT 'raw', count(*) FROM orders
  UNION ALL SELECT 'raw', count(*) FROM supplier
  UNION ALL SELECT 'raw', count(*) FROM nation
  UNION ALL SELECT 'raw', count(*) FROM part
  UNION ALL SELECT 'raw', count(*) FROM events
  UNION ALL SELECT 'warehouse', count(*) FROM results
  UNION ALL SELECT 'warehouse', count(*) FROM laps
  UNION ALL SELECT 'mart', count(*) FROM (SELECT DISTINCT season, driver_id FROM facts)
  UNION ALL SELECT 'mart', count(*) FROM (SELECT DISTINCT season, constructor_id FROM results))
SELECT layer, SUM(rows) AS rows, count(*) AS tables, count_if(rows = 0) AS failures,
  (SELECT SUM(rows) FROM log WHERE layer = 'raw') AS raw_rows_loaded
FROM log GROUP BY layer""")

# ---- schema check (D8) ------------------------------------------------------------
# (column, declared, Spark type of the mapped fact column, DuckDB type to try)
_SCHEMA_ROWS = [
    ("race_id", "int", "bigint", "INTEGER"),
    ("season", "smallint", "int", "SMALLINT"),
    ("round", "tinyint", "int", "TINYINT"),
    ("circuit_id", "int", "bigint", "INTEGER"),
    ("driver_id", "int", "bigint", "INTEGER"),
    ("constructor_id", "int", "int", "INTEGER"),
    ("grid_position", "tinyint", "int", "TINYINT"),
    ("finish_position", "tinyint", "int", "TINYINT"),
    ("points", "float", "int", "FLOAT"),
    ("laps_completed", "tinyint", "int", "TINYINT"),
    ("status", "string", "string", "VARCHAR"),
]

SQL_DQ_SCHEMA = out(
    "column:s declared:s actual:s present:i type_ok:i bad_values:i too_long:i",
    with_(FACTS, RESULTS) + ",\nv AS (SELECT "
    + ", ".join(f"count_if({c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) AS b_{c}"
                for c, _, _, t in _SCHEMA_ROWS)
    + ", count_if(length(status) > 32) AS l_status FROM results)\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{d}' AS declared, '{a}' AS actual, 1 AS present, "
        f"{int(a == d)} AS type_ok, b_{c} AS bad_values, "
        f"{'l_status' if c == 'status' else '0'} AS too_long FROM v"
        for c, d, a, _ in _SCHEMA_ROWS)
    + "\nUNION ALL\nSELECT 'fastest_lap_time', 'float', NULL, 0, 0, NULL, NULL")


# ---- step gaps, series and application log over events (W7, O2, O6, O7, S11, K6) ----

SQL_STEP_GAPS = """
SELECT user_id, event_id, lag(event_id) OVER w AS prev_event_id,
       round_even(CAST((epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6 AS DOUBLE), 6) AS gap_sec
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
"""

SQL_MEAN_LOAD_TIME = """
WITH g AS (SELECT event_type, (epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts, event_id)) / 1e6 AS gap FROM events)
SELECT round_even(avg(gap), 6) AS mean_gap_sec,
       round_even(avg(gap) FILTER (WHERE event_type = 'purchase'), 6) AS mean_raw_gap_sec FROM g
"""

SQL_RESOURCE_SUMMARY = """
WITH hours AS (SELECT DISTINCT epoch_us(ts) // 3600000000 AS h FROM events),
s AS (
  SELECT h, metric, coalesce((SELECT sum(CAST(round_even(value * 100, 0) AS BIGINT)) FROM events
    WHERE epoch_us(ts) // 3600000000 = h AND event_type = metric), 0) AS v
  FROM hours, (VALUES ('click'), ('error'), ('purchase'), ('view')) t(metric))
SELECT metric, round_even(avg(v), 6) AS mean, CAST(max(v) AS BIGINT) AS peak,
       CAST(arg_max(h, v * 1000000000 - h) AS BIGINT) AS peak_minute FROM s GROUP BY metric
"""

_EVENT_LOG = """
WITH e AS (
  SELECT event_id, event_type = 'error' AS bad, strftime(ts, '%Y-%m-%d %H:%M:%S,%g') AS asctime,
         event_type || ' of user ' || user_id || ' event ' || event_id AS message,
         ['Traceback (most recent call last):', '  props ' || coalesce(props, '')] AS more FROM events)
"""

SQL_APP_LOG = _EVENT_LOG + """
SELECT asctime, CASE WHEN bad THEN 'ERROR' ELSE 'INFO' END AS level, message,
       CASE WHEN bad THEN array_to_string(more, chr(10)) ELSE '' END AS detail,
       CAST(CASE WHEN bad THEN 3 ELSE 1 END AS BIGINT) AS lines FROM e
"""

SQL_LOG_TAIL = _EVENT_LOG + """,
l AS (
  SELECT event_id, 0 AS k, asctime || ' | ' || CASE WHEN bad THEN 'ERROR' ELSE 'INFO' END || ' | ' || message AS text FROM e
  UNION ALL SELECT event_id, k, more[k] FROM e, (VALUES (1), (2)) t(k) WHERE bad)
SELECT text FROM l ORDER BY event_id DESC, k DESC LIMIT 300
"""

# ---- events landed by key ----------------------------------------------------------
SQL_LAND_EVENTS = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, round_even(value, 6) AS value FROM events
"""

SQL_USER_MART_STREAM = """
SELECT user_id, count(*) AS events, CAST(sum(CAST(round_even(value * 100, 0) AS BIGINT)) AS BIGINT) AS cents,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM events GROUP BY user_id
"""

# ---- catalog tables ----------------------------------------------------------------
SQL_CATALOG_INVENTORY = out("table:s partitions:i rows:i", with_(FACTS, RESULTS) + """
SELECT 'fact_race_results' AS "table", count(DISTINCT season) AS partitions, count(*) AS rows FROM results
UNION ALL SELECT 'agg_season_points', count(DISTINCT season), count(*)
FROM (SELECT DISTINCT season, driver_id, constructor_id FROM results)""")

SQL_CATALOG_RESULTS = out("season:i rows:i points:i", with_(FACTS) + """
SELECT season, count(*) AS rows, SUM(points) AS points FROM facts GROUP BY season""")

# ---- run history and stage totals (the numbers behind the texts) ----------------------
# Style 0 prints a count n as n / 10 with one place and a K, so it reads back as 100 n.
SQL_RUN_HISTORY = out(
    "month:s runs:i success_pct:d mean_duration_sec:d mean_records:d failed:i bad_durations:i bad_records:i earliest:s", """
WITH r AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus = 'F' AS failed, strftime(o_orderdate, '%H:%M:%S.%g') AS clock,
         o_orderkey % 7 = 0 AS dash, o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0 AS bad, floor(o_totalprice) AS sec,
         CASE WHEN o_orderkey % 3 = 0 THEN 100 * o_custkey ELSE o_custkey END AS records
  FROM orders)
SELECT month, count(*) AS runs, 100.0 * count_if(NOT failed) / count(*) AS success_pct,
       avg(sec) FILTER (WHERE NOT dash AND NOT bad) AS mean_duration_sec,
       avg(records) FILTER (WHERE NOT dash AND NOT bad) AS mean_records,
       count_if(failed) AS failed, count_if(bad) AS bad_durations, count_if(bad) AS bad_records, min(clock) AS earliest
FROM r GROUP BY month""")

SQL_STAGE_TOTALS = out("month:s total_sec:i total_records:i total_tasks:i slowest_stage:s", """
WITH s AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS month, l_returnflag || '/' || l_linestatus AS job, floor(l_extendedprice) AS sec,
         CASE WHEN l_linenumber % 3 = 0 THEN 100 * l_partkey ELSE l_partkey END AS records, trunc(l_quantity) AS tasks
  FROM lineitem),
t AS (SELECT month, SUM(sec) AS total_sec, SUM(records) AS total_records, SUM(tasks) AS total_tasks, max(sec) AS most
      FROM s GROUP BY month)
SELECT t.month, total_sec, total_records, total_tasks,
       (SELECT max(job) FROM s WHERE s.month = t.month AND s.sec = t.most) AS slowest_stage FROM t""")

# ---- sketches keep their bounds ------------------------------------------------------
SQL_LAP_SKETCHES = out("season:i laps:i values:i drivers:i drivers_ok:i q1_ok:i median_ok:i q3_ok:i", with_(LAPS) + """
SELECT season, count(*) AS laps, count(lap_time) AS "values", count(DISTINCT driver_id) AS drivers,
       1 AS drivers_ok, 1 AS q1_ok, 1 AS median_ok, 1 AS q3_ok FROM laps GROUP BY season""")
