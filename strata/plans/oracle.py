"""Reference SQL for every registered query, runnable by DuckDB on the test tables.

The SQL is written independently of the Spark forms: it uses the plain window
shapes (table-wide ``rank()``, ``max() OVER (PARTITION BY season)``) where
the Spark side uses the scalable rewrites, so a match also checks those
rewrites at the size of the run. Queries about an order return the position as a
column. Types are cast to Spark's (``rank`` -> INTEGER, sums of ints ->
BIGINT), and null ordering is written out (Spark: ASC NULLS FIRST, DESC
NULLS LAST).
"""

from __future__ import annotations

from strata.plans import robust

SEASON = "CAST(year({c}) * 12 + month({c}) - 1 AS INTEGER)"
ROUND = "CAST(day({c}) AS INTEGER)"

CTES = {
    # ---- bronze stand-ins -------------------------------------------------------
    "b_circuits": """
SELECT n.n_nationkey AS circuit_id, lower(n.n_name) AS circuit_ref, n.n_name AS name,
       n.n_name AS location, r.r_name AS country, CAST(NULL AS DOUBLE) AS latitude,
       CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS INTEGER) AS altitude
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "b_constructors": """
SELECT s.s_suppkey AS constructor_id, lower(s.s_name) AS constructor_ref, s.s_name AS name,
       n.n_name AS nationality
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "b_drivers": """
SELECT c.c_custkey AS driver_id, lower(c.c_name) AS driverRef,
       CAST(NULL AS INTEGER) AS number_driver, CAST(NULL AS VARCHAR) AS code,
       c.c_mktsegment AS forename, c.c_name AS surname, CAST(NULL AS DATE) AS dob,
       n.n_name AS nationality
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "b_races": f"""
SELECT CASE WHEN o.o_orderstatus = 'P' THEN -1 - o.o_orderkey ELSE o.o_orderkey END AS race_id,
       {SEASON.format(c='o.o_orderdate')} AS race_year,
       {ROUND.format(c='o.o_orderdate')} AS round, c.c_nationkey AS circuit_id,
       'order ' || CAST(o.o_orderkey AS VARCHAR) AS name,
       CAST(o.o_orderdate AS DATE) AS date_race
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
    "b_results": """
SELECT l.l_orderkey * 8 + l.l_linenumber AS result_id, l.l_orderkey AS race_id,
       o.o_custkey AS driver_id, l.l_suppkey AS constructor_id,
       CAST(NULL AS VARCHAR) AS number_results, CAST(NULL AS INTEGER) AS grid,
       CASE WHEN l.l_returnflag = 'R' THEN '\\N' ELSE CAST(l.l_linenumber AS VARCHAR) END
         AS position,
       CASE WHEN l.l_returnflag = 'R' THEN 'R' ELSE CAST(l.l_linenumber AS VARCHAR) END
         AS position_text,
       l.l_linenumber AS position_order, l.l_quantity AS points,
       CAST(NULL AS INTEGER) AS laps, CAST(NULL AS VARCHAR) AS time,
       CASE WHEN l.l_returnflag = 'R' THEN '\\N'
            ELSE CAST(CAST(l.l_quantity * 60000 AS BIGINT) AS VARCHAR) END AS milliseconds,
       CAST(substring(o.o_orderpriority, 1, 1) AS INTEGER) AS status_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "b_status": """
SELECT DISTINCT CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS statusId,
       o_orderpriority AS status
FROM orders""",
    "b_standings_round": f"""
SELECT o_custkey AS driverId, {SEASON.format(c='o_orderdate')} AS season,
       {ROUND.format(c='o_orderdate')} AS rnd, min(o_orderkey) AS driverStandingsId,
       max(o_orderkey) AS raceId,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS points,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS INTEGER) AS wins
FROM orders GROUP BY 1, 2, 3""",
    "b_standings": """
SELECT driverStandingsId, raceId, driverId, points,
       CAST(rank() OVER (PARTITION BY season, rnd ORDER BY points DESC NULLS LAST) AS INTEGER)
         AS position, wins
FROM b_standings_round""",
    # ---- silver ---------------------------------------------------------------
    "dim_circuits": """
SELECT circuit_id, name AS circuit_name, location, country, latitude, longitude
FROM b_circuits""",
    "dim_drivers": """
SELECT driver_id, code, forename, surname, concat_ws(' ', forename, surname) AS full_name,
       dob AS date_of_birth, nationality
FROM b_drivers""",
    "dim_constructors": """
SELECT constructor_id, name AS constructor_name, nationality FROM b_constructors""",
    "dim_status": """
SELECT statusId AS status_id, status AS status_description FROM b_status""",
    "dim_races": """
SELECT race_id, race_year, round, circuit_id, name AS race_name, date_race AS race_date
FROM b_races""",
    "fact_results": """
SELECT r.result_id, r.race_id, r.driver_id, r.constructor_id, CAST(r.grid AS INTEGER) AS grid,
       r.position_order AS finish_position, r.points, r.laps, r.status_id, d.race_year,
       d.circuit_id,
       CASE WHEN s.status_description = '5-LOW' THEN TRUE
            WHEN regexp_matches(s.status_description, '^\\d+-H') THEN TRUE
            ELSE FALSE END AS finished,
       r.position_order IN (1, 2, 3) AS is_podium,
       r.position_order = 1 AS is_win
FROM b_results r
LEFT JOIN dim_races d ON r.race_id = d.race_id
LEFT JOIN dim_status s ON r.status_id = s.status_id""",
    "fact_driver_standings": """
SELECT s.driverStandingsId AS driver_standings_id, d.race_id, s.driverId AS driver_id,
       CAST(s.points AS DOUBLE) AS points, CAST(s.position AS INTEGER) AS position,
       CAST(s.wins AS INTEGER) AS wins, d.race_year, d.round
FROM b_standings s LEFT JOIN dim_races d ON s.raceId = d.race_id""",
    # ---- gold -----------------------------------------------------------------
    "constructor_career": """
SELECT f.constructor_id, c.constructor_name, c.nationality, CAST(sum(CAST(f.points AS DECIMAL(18, 4))) AS DOUBLE) AS total_points,
       CAST(sum(CAST(f.is_win AS INTEGER)) AS INTEGER) AS total_wins,
       CAST(sum(CAST(f.is_podium AS INTEGER)) AS INTEGER) AS total_podiums,
       min(f.race_year) AS first_season, max(f.race_year) AS last_season
FROM fact_results f JOIN dim_constructors c ON f.constructor_id = c.constructor_id
GROUP BY f.constructor_id, c.constructor_name, c.nationality""",
    "driver_career": """
SELECT f.driver_id, d.full_name, d.nationality, CAST(sum(CAST(f.points AS DECIMAL(18, 4))) AS DOUBLE) AS total_points,
       CAST(sum(CAST(f.is_win AS INTEGER)) AS INTEGER) AS total_wins,
       CAST(sum(CAST(f.is_podium AS INTEGER)) AS INTEGER) AS total_podiums,
       CAST(count(DISTINCT f.race_id) AS INTEGER) AS races_disputed,
       min(f.race_year) AS first_season, max(f.race_year) AS last_season
FROM fact_results f JOIN dim_drivers d ON f.driver_id = d.driver_id
GROUP BY f.driver_id, d.full_name, d.nationality""",
    "season_totals": """
SELECT f.race_year, f.constructor_id, c.constructor_name, CAST(sum(CAST(f.points AS DECIMAL(18, 4))) AS DOUBLE) AS total_points,
       CAST(sum(CAST(f.is_win AS INTEGER)) AS INTEGER) AS wins,
       CAST(sum(CAST(f.is_podium AS INTEGER)) AS INTEGER) AS podiums
FROM fact_results f JOIN dim_constructors c ON f.constructor_id = c.constructor_id
GROUP BY f.race_year, f.constructor_id, c.constructor_name""",
    "constructor_standings": """
SELECT race_year, constructor_id, constructor_name, total_points, wins, podiums,
       CAST(dense_rank() OVER (PARTITION BY race_year ORDER BY total_points DESC NULLS LAST)
            AS INTEGER) AS season_rank
FROM season_totals""",
    "leaders": """
SELECT constructor_id, constructor_name, race_year,
       CAST(row_number() OVER (PARTITION BY constructor_id ORDER BY race_year ASC NULLS FIRST)
            AS INTEGER) AS row_number
FROM constructor_standings WHERE season_rank = 1""",
    "nation_totals": """
SELECT f.race_year, n.n_nationkey AS constructor_id, n.n_name AS constructor_name,
       sum(CAST(f.points AS DECIMAL(18, 4))) AS total_points
FROM fact_results f JOIN supplier s ON f.constructor_id = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY f.race_year, n.n_nationkey, n.n_name""",
    "nation_leaders": """
SELECT constructor_id, constructor_name, race_year,
       CAST(row_number() OVER (PARTITION BY constructor_id ORDER BY race_year ASC NULLS FIRST)
            AS INTEGER) AS row_number
FROM (SELECT *, dense_rank() OVER (PARTITION BY race_year ORDER BY total_points DESC) AS season_rank
      FROM nation_totals)
WHERE season_rank = 1""",
    "constructor_dominance": """
SELECT constructor_id, constructor_name, min(race_year) AS streak_start_year,
       max(race_year) AS streak_end_year, CAST(count(*) AS INTEGER) AS streak_length
FROM nation_leaders
GROUP BY constructor_id, constructor_name, race_year - row_number
HAVING count(*) >= 2""",
    "last_round": """
SELECT *, max(round) OVER (PARTITION BY race_year) AS max_round FROM fact_driver_standings""",
    "season_champions": """
SELECT s.race_year, s.driver_id, d.full_name, s.points AS champion_points
FROM last_round s JOIN dim_drivers d ON s.driver_id = d.driver_id
WHERE s.round = s.max_round AND s.position = 1""",
    "drivers_without_title": """
SELECT driver_id, full_name, total_wins, total_points,
       CAST(rank() OVER (ORDER BY total_wins DESC NULLS LAST) AS INTEGER) AS rank_by_wins
FROM driver_career
WHERE driver_id NOT IN (SELECT driver_id FROM season_champions WHERE driver_id IS NOT NULL)
  AND total_wins > 0""",
}

# Dependencies between the CTEs above (emitted in this order when needed).
_DEPS = {
    "dim_circuits": ["b_circuits"], "dim_drivers": ["b_drivers"],
    "dim_constructors": ["b_constructors"], "dim_status": ["b_status"],
    "dim_races": ["b_races"],
    "fact_results": ["b_results", "dim_races", "dim_status"],
    "b_standings": ["b_standings_round"],
    "fact_driver_standings": ["b_standings", "dim_races"],
    "constructor_career": ["fact_results", "dim_constructors"],
    "driver_career": ["fact_results", "dim_drivers"],
    "season_totals": ["fact_results", "dim_constructors"],
    "constructor_standings": ["season_totals"],
    "leaders": ["constructor_standings"],
    "nation_totals": ["fact_results"], "nation_leaders": ["nation_totals"],
    "constructor_dominance": ["nation_leaders"],
    "last_round": ["fact_driver_standings"],
    "season_champions": ["last_round", "dim_drivers"],
    "drivers_without_title": ["driver_career", "season_champions"],
}


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in _DEPS.get(name, []):
            visit(dep)
        ordered.append(name)

    for n in names:
        visit(n)
    return ordered


def with_ctes(body: str, *uses: str) -> str:
    """``WITH <needed ctes> <body>``; ``uses`` names the CTEs the body reads."""
    names = _closure(list(uses))
    defs = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in names)
    return f"WITH {defs}\n{body.strip()}"


def table(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}", name)


RANGE = "race_year BETWEEN 23964 AND 23999"   # 1997-01 .. 1999-12 as month indices

POSITION = "CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position"

_CSV_RACES = """
SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
            ELSE o_orderkey END AS race_id,
       CAST(year(o_orderdate) AS INTEGER) AS race_year,
       CAST(month(o_orderdate) AS INTEGER) AS round,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS circuit_id,
       o_orderpriority || ', ' || o_orderstatus AS name,
       CAST(o_orderdate AS DATE) AS date_race,
       CASE WHEN o_orderstatus = 'P' THEN '\\N' ELSE '12:00:00' END AS time
FROM orders"""


def _flag(flag: str, source: str) -> str:
    return with_ctes(f"SELECT result_id, race_id, {source}, {flag} FROM fact_results",
                     "fact_results")


ORACLE: dict[str, str] = {
    # sources
    "csv_explicit_schema": _CSV_RACES,
    "object_store_path": _CSV_RACES,
    "csv_rejects": f"SELECT * FROM ({_CSV_RACES}) WHERE race_id IS NULL",
    "csv_infer_schema": """
SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
            THEN 'x' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS raceId,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS round,
       CASE WHEN o_orderstatus = 'P' THEN '\\N' ELSE CAST(o_custkey AS VARCHAR) END AS circuitId,
       o_orderpriority || ', ' || o_orderstatus AS name, CAST(o_orderdate AS DATE) AS date,
       CASE WHEN o_orderstatus = 'P' THEN '\\N' ELSE '12:00:00' END AS time
FROM orders""",
    "normalize_null_markers": with_ctes("""
SELECT result_id, race_id, TRY_CAST(NULLIF(position, '\\N') AS INTEGER) AS position,
       position_text, TRY_CAST(NULLIF(milliseconds, '\\N') AS BIGINT) AS milliseconds
FROM b_results""", "b_results"),
    # sinks
    "layer_roundtrip": table("dim_drivers"),
    "overwrite_idempotent": table("constructor_career"),
    "partitioned_overwrite": table("dim_races"),
    "layer_lifecycle": with_ctes("""
SELECT *, TRUE AS in_layer, CAST(0 AS INTEGER) AS tables_left, TRUE AS layer_gone
FROM dim_circuits""", "dim_circuits"),
    "sql_readback": with_ctes(f"""
SELECT *, {POSITION.format(order='race_year DESC NULLS LAST, constructor_id')}
FROM constructor_standings WHERE season_rank = 1""", "constructor_standings"),
    "schema_contract": table("driver_career"),
    # projections, casts, flags
    "project_rename": """
SELECT s_suppkey AS constructor_id, s_name AS name, s_nationkey AS nation_id FROM supplier""",
    "audit_column": with_ctes(
        "SELECT constructor_id, name, TRUE AS has_ingestion_date FROM b_constructors",
        "b_constructors"),
    "cast_columns": with_ctes("""
SELECT driverStandingsId, raceId, driverId, CAST(points AS DOUBLE) AS points,
       CAST(position AS INTEGER) AS position, CAST(CAST(position AS VARCHAR) AS INTEGER)
         AS positionText, CAST(wins AS INTEGER) AS wins
FROM b_standings""", "b_standings"),
    "dim_circuits": table("dim_circuits"),
    "dim_drivers": table("dim_drivers"),
    "dim_constructors": table("dim_constructors"),
    "dim_status": table("dim_status"),
    "dim_races": table("dim_races"),
    "dim_full_name": with_ctes("SELECT driver_id, full_name FROM dim_drivers", "dim_drivers"),
    "finished_flag": _flag("finished", "status_id"),
    "podium_flag": _flag("is_podium", "finish_position"),
    "win_flag": _flag("is_win", "finish_position"),
    # joins
    "fact_left_enrich": table("fact_results"),
    "standings_left_expr": table("fact_driver_standings"),
    "duplicate_keys": with_ctes("""
SELECT result_id, count(*) AS occurrences FROM b_results GROUP BY result_id
HAVING count(*) > 1""", "b_results"),
    # aggregates
    "career_rollup": table("constructor_career"),
    "career_count_distinct": table("driver_career"),
    "conditional_counts": with_ctes("""
SELECT driver_id, CAST(sum(CAST(is_win AS INTEGER)) AS INTEGER) AS total_wins,
       CAST(sum(CAST(is_podium AS INTEGER)) AS INTEGER) AS total_podiums,
       CAST(sum(CAST(finished AS INTEGER)) AS INTEGER) AS total_finished
FROM fact_results GROUP BY driver_id""", "fact_results"),
    "distinct_keys": with_ctes("SELECT DISTINCT driver_id FROM season_champions",
                               "season_champions"),
    # windows
    "season_standings_dense_rank": table("constructor_standings"),
    "standings_fractional_points": with_ctes(f"""
SELECT *, CAST(dense_rank() OVER (PARTITION BY race_year ORDER BY total_points DESC NULLS LAST)
               AS INTEGER) AS season_rank
FROM (SELECT race_year, constructor_id, constructor_name, {robust.EXACT} AS total_points, wins, podiums
      FROM (SELECT d.race_year, l.l_suppkey AS constructor_id, c.constructor_name,
                   sum(CAST(CAST(l.l_extendedprice AS DOUBLE) * 8796093022208.0 AS HUGEINT)) AS s,
                   CAST(sum(CAST(l.l_linenumber = 1 AS INTEGER)) AS INTEGER) AS wins,
                   CAST(sum(CAST(l.l_linenumber IN (1, 2, 3) AS INTEGER)) AS INTEGER) AS podiums
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
            LEFT JOIN dim_races d ON l.l_orderkey = d.race_id
            JOIN dim_constructors c ON l.l_suppkey = c.constructor_id
            GROUP BY 1, 2, 3))""", "dim_races", "dim_constructors"),
    "entity_row_number": table("leaders"),
    "consecutive_streaks": table("constructor_dominance"),
    "driver_season_streaks": with_ctes("""
SELECT driver_id, min(race_year) AS streak_start_year, max(race_year) AS streak_end_year,
       CAST(count(*) AS INTEGER) AS streak_length
FROM (SELECT driver_id, race_year,
             row_number() OVER (PARTITION BY driver_id ORDER BY race_year ASC NULLS FIRST) AS rn
      FROM (SELECT DISTINCT driver_id, race_year FROM fact_driver_standings))
GROUP BY driver_id, race_year - rn
HAVING count(*) >= 2""", "fact_driver_standings"),
    "season_champions": table("season_champions"),
    "never_champion_ranked": table("drivers_without_title"),
    "season_range_filter": with_ctes(f"SELECT * FROM constructor_standings WHERE {RANGE}",
                                     "constructor_standings"),
    # sorts, top-k, dashboard
    "topk_career": with_ctes("""
SELECT * FROM driver_career ORDER BY total_points DESC NULLS LAST, driver_id ASC NULLS FIRST
LIMIT 20""", "driver_career"),
    "sorted_career": with_ctes(f"""
SELECT *, {POSITION.format(order='total_points DESC NULLS LAST, constructor_id')}
FROM constructor_career""", "constructor_career"),
    "sorted_standings": with_ctes(f"""
SELECT *, {POSITION.format(order='race_year NULLS FIRST, season_rank, constructor_id')}
FROM constructor_standings""", "constructor_standings"),
    "limit_preview": with_ctes("""
SELECT least(20, count(*)) AS n_rows, least(20, count(*)) AS n_in_source FROM dim_drivers""",
                               "dim_drivers"),
    "dash_top10_drivers": with_ctes("""
SELECT driver_id, full_name, nationality, total_wins FROM driver_career
ORDER BY total_wins DESC NULLS LAST, driver_id ASC NULLS FIRST LIMIT 10""", "driver_career"),
    "dash_top10_constructors": with_ctes("""
SELECT constructor_id, constructor_name, nationality, total_wins FROM constructor_career
ORDER BY total_wins DESC NULLS LAST, constructor_id ASC NULLS FIRST LIMIT 10""",
                                         "constructor_career"),
    "dash_champion_points": with_ctes(
        "SELECT race_year, full_name, champion_points FROM season_champions",
        "season_champions"),
    "dash_uncrowned": with_ctes("SELECT * FROM drivers_without_title WHERE rank_by_wins <= 10",
                                "drivers_without_title"),
    "dash_streaks": with_ctes("""
SELECT constructor_name, streak_start_year, streak_end_year, streak_length
FROM constructor_dominance""", "constructor_dominance"),
    "dash_top5_chosen_season": with_ctes(
        "SELECT * FROM constructor_standings WHERE race_year = 23964 AND season_rank <= 5",
        "constructor_standings"),
    "dash_top5_selected_season": with_ctes("""
SELECT * FROM constructor_standings
WHERE race_year = (SELECT max(race_year) FROM constructor_standings) AND season_rank <= 5""",
                                           "constructor_standings"),
    "dash_top5_of_season": with_ctes(
        "SELECT * FROM constructor_standings WHERE season_rank <= 5", "constructor_standings"),
}

ORACLE.update(robust.oracle(with_ctes))
