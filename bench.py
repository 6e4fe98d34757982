"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3; the median is reported). Every run builds the query
plans again (only the parquet file listings are cached, as a catalog would)
and executes them to the ``noop`` sink, after one warm-up run. ``queries``
(and the headline ``value``, their sum) is end-to-end: ``plan_build`` (the
Python-side construction, including any eager step of an operator such as a
checkpoint of a small intermediate table or a broadcast size check) plus
``execute`` (the final job). As in the modelled
job, silver queries read stored bronze tables, gold queries read stored
silver tables, and the gold tables built from other gold tables (dominance,
drivers without title) read those stored gold tables: all of them are written
once at the start, and that one-time cost is reported as ``materialize_once``. ``fact_left_enrich`` and
``standings_left_expr`` run the silver fact joins on every run.

``reference_form`` times the modelled pipeline's plain shapes on the same
data, as SQL over the same stored tables: table-wide single-partition ``rank``,
whole-partition ``max`` window, per-season ``dense_rank`` window, and a global sort
before the write. Runs
of both forms are interleaved so that neither gets a warmer JVM.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.oracle import CTES  # noqa: E402
from strata.plans.queries import QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402
from strata.sources.standins import StandInTables  # noqa: E402

HEADLINE = [
    "fact_left_enrich", "standings_left_expr", "career_rollup", "career_count_distinct",
    "season_standings_dense_rank", "consecutive_streaks", "season_champions",
    "never_champion_ranked", "topk_career", "driver_season_streaks", "dash_top5_of_season",
]


def _with(body: str, *names: str) -> str:
    defs = ",\n".join(f"{n} AS ({CTES[n]})" for n in names)
    return f"WITH {defs}\n{body}" if defs else body


# The modelled pipeline's plain shapes as SQL over the same stored tables.
REFERENCE_SQL = {
    "fact_left_enrich": """
SELECT r.result_id, r.race_id, r.driver_id, r.constructor_id, CAST(r.grid AS INT) AS grid,
       r.position_order AS finish_position, CAST(r.points AS DOUBLE) AS points, r.laps, r.status_id,
       d.race_year, d.circuit_id,
       coalesce(s.status_description = '5-LOW' OR s.status_description RLIKE '^[0-9]+-H', FALSE)
         AS finished,
       r.position_order IN (1, 2, 3) AS is_podium, r.position_order = 1 AS is_win
FROM b_results r LEFT JOIN dim_races d ON r.race_id = d.race_id
LEFT JOIN dim_status s ON r.status_id = s.status_id""",
    "standings_left_expr": """
SELECT s.driverStandingsId, d.race_id, s.driverId, CAST(s.points AS DOUBLE) AS points,
       CAST(s.position AS INT) AS position, CAST(s.wins AS INT) AS wins, d.race_year, d.round
FROM b_driver_standings s LEFT JOIN dim_races d ON s.raceId = d.race_id""",
    "career_rollup": CTES["constructor_career"] + " ORDER BY total_points DESC",
    "career_count_distinct": CTES["driver_career"] + " ORDER BY total_points DESC",
    "season_standings_dense_rank": _with(CTES["constructor_standings"], "season_totals"),
    "consecutive_streaks": _with(CTES["constructor_dominance"], "nation_totals", "nation_leaders"),
    "season_champions": _with(CTES["season_champions"], "last_round"),
    "never_champion_ranked": CTES["drivers_without_title"],
    "topk_career": "SELECT * FROM driver_career ORDER BY total_points DESC, driver_id LIMIT 20",
    "driver_season_streaks": """
SELECT driver_id, min(race_year) AS first, max(race_year) AS last, count(*) AS n
FROM (SELECT driver_id, race_year, row_number() OVER (PARTITION BY driver_id ORDER BY race_year) AS rn
      FROM (SELECT DISTINCT driver_id, race_year FROM fact_driver_standings))
GROUP BY driver_id, race_year - rn HAVING count(*) >= 2""",
    "dash_top5_of_season": "SELECT * FROM constructor_standings WHERE season_rank <= 5",
}
REFERENCE_FORMS = {name: (lambda spark, sf_dir, sql=sql: spark.sql(sql))
                   for name, sql in REFERENCE_SQL.items()}


def register_views(tables: StandInTables) -> None:
    for name in ("results", "driver_standings"):
        tables.bronze(name).createOrReplaceTempView(f"b_{name}")
    for name in ("dim_races", "dim_status", "dim_drivers", "dim_constructors", "fact_results",
                 "fact_driver_standings"):
        tables.stored(name).createOrReplaceTempView(name)
    for name in ("constructor_standings", "driver_career", "season_champions"):
        tables.stored_gold(name).createOrReplaceTempView(name)
    for name in ("supplier", "nation"):
        tables.table(name).createOrReplaceTempView(name)


def _run(spark, build, sf_dir):
    StandInTables.of(spark, sf_dir).reset_plans()
    t0 = time.perf_counter()
    df = build(spark, sf_dir)
    t1 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return t1 - t0, time.perf_counter() - t1


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          app_name="strata-bench", extra={"spark.driver.memory": "8g"})
    # silver loads read stored bronze tables and gold loads read stored silver
    # tables: derive and write them once, timed apart
    tables = StandInTables.of(spark, sf_dir)
    materialize = {}
    for layer, names in (("bronze", ("circuits", "constructors", "drivers", "races", "results",
                                     "status", "driver_standings")),
                         ("silver", ("dim_drivers", "dim_constructors", "fact_results",
                                     "fact_driver_standings")),
                         ("gold", ("constructor_standings", "driver_career",
                                   "season_champions"))):  # read by other gold tables
        for name in names:
            t0 = time.perf_counter()
            {"bronze": tables.bronze, "silver": tables.stored,
             "gold": tables.stored_gold}[layer](name)
            materialize[f"{layer}.{name}"] = round(time.perf_counter() - t0, 3)
    register_views(tables)
    jobs = [("ours", n, QUERIES[n]) for n in HEADLINE]
    jobs += [("reference", n, fn) for n, fn in REFERENCE_FORMS.items()]
    times: dict[tuple[str, str], list[float]] = {}
    builds: dict[tuple[str, str], list[float]] = {}
    for i in range(runs + 1):
        for form, name, fn in jobs:
            build, run = _run(spark, fn, sf_dir)
            if i:                   # run 0 warms the JVM and the file caches
                times.setdefault((form, name), []).append(run)
                builds.setdefault((form, name), []).append(build)
    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    med_build = {k: round(statistics.median(v), 3) for k, v in builds.items()}
    total = {k: round(statistics.median(b + r for b, r in zip(builds[k], times[k])), 3)
             for k in times}
    ours = {n: total[("ours", n)] for n in HEADLINE}
    reference = {n: total[("reference", n)] for n in REFERENCE_FORMS}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(ours.values()), 3),
        "unit": "sec", "queries": ours, "reference_form": reference,
        "execute": {n: med[("ours", n)] for n in HEADLINE},
        "plan_build": {n: med_build[("ours", n)] for n in HEADLINE},
        "reference_form_execute": {n: med[("reference", n)] for n in REFERENCE_FORMS},
        "reference_form_plan_build": {n: med_build[("reference", n)] for n in REFERENCE_FORMS},
        "reference_form_total": round(sum(reference.values()), 3),
        "materialize_once": materialize,
        "materialize_once_total": round(sum(materialize.values()), 3),
        "sf": sf,
        "cpus": cpus, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
