"""The registered queries: one per operator row of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame that reads the
whole test tables (through ``StandInTables``). Queries that exercise sinks write
to a fresh location below the shared checkpoint folder and return the
read-back frame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import (clean_null_markers, cast_columns, rename,
                                      with_audit_column)
from strata.operators.enrich import distinct_keys, duplicate_keys
from strata.operators.ranking import global_rank, sorted_for_read, top_k, top_k_per_group
from strata.operators.streaks import with_row_number
from strata.plans import dashboard, gold, robust, schemas, silver
from strata.session import scratch_path, store
from strata.sinks.tables import (check_contract, create_layer, current_namespace, drop_layer,
                                 drop_table, list_layers, overwrite_table, preview, use_layer)
from strata.sources.csv import ingest, profile_csv, read_csv_positional, source_path
from strata.sources.exports import export_races_csv
from strata.sources.standins import StandInTables
from strata.sources.tables import read_table, sql_readback

Query = Callable[[SparkSession, str], DataFrame]

# Season window used by the range filter queries: 1997-01 .. 1999-12.
RANGE_FROM, RANGE_TO = 1997 * 12, 1999 * 12 + 11


def _t(spark: SparkSession, sf_dir: str) -> StandInTables:
    return StandInTables.of(spark, sf_dir)


def _silver(name: str) -> Query:
    return lambda spark, sf_dir: _t(spark, sf_dir).silver[name]


def _gold(name: str) -> Query:
    return lambda spark, sf_dir: _t(spark, sf_dir).gold(name)


def _gold_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A gold table as read-backs and dashboard views see it: the stored table."""
    return _t(spark, sf_dir).stored_gold(name)


# ---- sources -----------------------------------------------------------------------
def _races(spark: SparkSession, path: str) -> DataFrame:
    raw = read_csv_positional(spark, path, schemas.raw_schema("races", T.LongType()))
    pairs = [(s, d) for s, d in schemas.BRONZE_RENAMES["races"]] + [("time", "time")]
    return raw.select(*[F.col(s).alias(d) for s, d in pairs])


def _bronze_races_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _races(spark, export_races_csv(_t(spark, sf_dir)))


def object_store_path(spark, sf_dir):
    """The export read through a full URI, as ``<root>/<entity>.csv``."""
    path = export_races_csv(_t(spark, sf_dir), entity="races")
    root = path.rsplit("/", 1)[0]
    return _races(spark, source_path(root if ":/" in root else f"file://{root}", "races"))


def csv_explicit_schema(spark, sf_dir):
    return _bronze_races_from_csv(spark, sf_dir)


def csv_rejects(spark, sf_dir):
    return ingest(_bronze_races_from_csv(spark, sf_dir), ["race_id"]).rejects


def normalize_null_markers(spark, sf_dir):
    results = _t(spark, sf_dir).bronze("results")
    cleaned = clean_null_markers(results, {"position": "int", "milliseconds": "bigint"})
    return cleaned.select("result_id", "race_id", "position", "position_text", "milliseconds")


def csv_infer_schema(spark, sf_dir):
    path = export_races_csv(_t(spark, sf_dir))
    inferred = profile_csv(spark, path)
    return read_csv_positional(spark, path, inferred).select(
        "raceId", "year", "round", "circuitId", "name", "date", "time")


# ---- sinks -------------------------------------------------------------------------
def _scratch_layer(spark: SparkSession, name: str) -> str:
    location = scratch_path(spark, name)
    database = f"strata_{name}_{location.rsplit('-', 1)[-1][:12]}"
    create_layer(spark, database, location)
    return database


def layer_roundtrip(spark, sf_dir):
    t = _t(spark, sf_dir)
    db = _scratch_layer(spark, "roundtrip")
    overwrite_table(t.silver["dim_drivers"], f"{db}.dim_drivers")
    return read_table(spark, f"{db}.dim_drivers")


def overwrite_idempotent(spark, sf_dir):
    t = _t(spark, sf_dir)
    db = _scratch_layer(spark, "idempotent")
    career = t.gold("constructor_career")
    overwrite_table(career, f"{db}.constructor_career")
    overwrite_table(career, f"{db}.constructor_career")
    return read_table(spark, f"{db}.constructor_career")


def partitioned_overwrite(spark, sf_dir):
    t = _t(spark, sf_dir)
    db = _scratch_layer(spark, "partitioned")
    overwrite_table(t.silver["dim_races"], f"{db}.dim_races", partition_by=["race_year"])
    return read_table(spark, f"{db}.dim_races")


def layer_lifecycle(spark, sf_dir):
    """Create a layer, use it, read a table by its short name, drop table and layer."""
    db, before = _scratch_layer(spark, "lifecycle"), current_namespace(spark)[1]
    overwrite_table(_t(spark, sf_dir).silver["dim_circuits"], f"{db}.dim_circuits")
    use_layer(spark, db)
    rows = store(spark.table("dim_circuits")
                 .withColumn("in_layer", F.expr("current_schema()") == db), "lifecycle")
    use_layer(spark, before)
    drop_table(spark, f"{db}.dim_circuits")
    left = len(spark.catalog.listTables(db))
    drop_layer(spark, db)
    return rows.withColumns({"tables_left": F.lit(left), "layer_gone": F.lit(db not in list_layers(spark, db))})


def _with_position(ordered: DataFrame) -> DataFrame:
    """The place of every row in the order in which the frame is read."""
    at = ordered.withColumn("__at", F.monotonically_increasing_id())
    return global_rank(at, "__at", "position", descending=False).drop("__at")


def sql_readback_query(spark, sf_dir):
    t = _t(spark, sf_dir)
    db = _scratch_layer(spark, "readback")
    overwrite_table(t.gold("constructor_standings"), f"{db}.constructor_standings",
                    partition_by=["race_year"])
    return _with_position(sql_readback(
        spark, f"{db}.constructor_standings", where="season_rank = 1",
        order_by=["race_year DESC", "constructor_id"]))


def schema_contract(spark, sf_dir):
    career = _t(spark, sf_dir).gold("driver_career")
    return check_contract(career, schemas.gold_schema("driver_career", T.LongType()),
                          name="driver_career")


# ---- projections, casts, flags -----------------------------------------------------
def project_rename(spark, sf_dir):
    supplier = _t(spark, sf_dir).table("supplier")
    return rename(supplier.select("s_suppkey", "s_name", "s_nationkey"),
                  {"s_suppkey": "constructor_id", "s_name": "name",
                   "s_nationkey": "nation_id"})


def audit_column(spark, sf_dir):
    bronze = with_audit_column(_t(spark, sf_dir).bronze("constructors"))
    return bronze.select("constructor_id", "name",
                         F.col("ingestion_date").isNotNull().alias("has_ingestion_date"))


def cast_columns_query(spark, sf_dir):
    standings = _t(spark, sf_dir).bronze("driver_standings")
    return cast_columns(standings, {"points": "double", "position": "int", "wins": "int",
                                    "positionText": "int"})


def dim_full_name(spark, sf_dir):
    return _t(spark, sf_dir).silver["dim_drivers"].select("driver_id", "full_name")


def _fact_flag(flag: str, source: str) -> Query:
    def query(spark, sf_dir):
        fact = _t(spark, sf_dir).silver["fact_results"]
        return fact.select("result_id", "race_id", source, flag)
    return query


# ---- aggregates, windows -----------------------------------------------------------
def conditional_counts(spark, sf_dir):
    from strata.functions.columns import conditional_count
    fact = _t(spark, sf_dir).stored("fact_results")
    return fact.groupBy("driver_id").agg(
        conditional_count("is_win").alias("total_wins"),
        conditional_count("is_podium").alias("total_podiums"),
        conditional_count("finished").alias("total_finished"))


def distinct_keys_query(spark, sf_dir):
    return distinct_keys(_gold_table(spark, sf_dir, "season_champions"), "driver_id")


def duplicate_result_keys(spark, sf_dir):
    return duplicate_keys(_t(spark, sf_dir).bronze("results"), "result_id")


def entity_row_number(spark, sf_dir):
    standings = _gold_table(spark, sf_dir, "constructor_standings")
    leaders = (standings.filter(F.col("season_rank") == 1)
               .select("constructor_id", "constructor_name", "race_year"))
    return with_row_number(leaders, ["constructor_id"], "race_year")


def driver_season_streaks(spark, sf_dir):
    """The gaps-and-islands operator over every driver's active seasons."""
    from strata.operators.streaks import consecutive_streaks
    standings = _t(spark, sf_dir).stored("fact_driver_standings")
    seasons = standings.select("driver_id", "race_year").distinct()
    return consecutive_streaks(seasons, ["driver_id"], "race_year")


def season_range_filter(spark, sf_dir):
    standings = _gold_table(spark, sf_dir, "constructor_standings")
    return dashboard.season_range(standings, RANGE_FROM, RANGE_TO)


# ---- sorts, top-k ------------------------------------------------------------------
def topk_career(spark, sf_dir):
    career = _gold_table(spark, sf_dir, "driver_career")
    return top_k(career, [F.col("total_points").desc(), F.col("driver_id")], 20)


def sorted_career(spark, sf_dir):
    return _with_position(sorted_for_read(
        _gold_table(spark, sf_dir, "constructor_career"), F.col("total_points").desc(),
        "constructor_id"))


def sorted_standings(spark, sf_dir):
    return _with_position(sorted_for_read(
        _gold_table(spark, sf_dir, "constructor_standings"), "race_year", "season_rank",
        "constructor_id"))


def limit_preview(spark, sf_dir):
    """Which rows an unordered LIMIT returns is open: how many it returns, and how many
    of them are rows of the source, is not."""
    source = _t(spark, sf_dir).stored("dim_drivers")
    shown = store(preview(source, 20), "preview")
    found = shown.join(source, [shown[c].eqNullSafe(source[c]) for c in shown.columns], "left_semi")
    return shown.agg(F.count("*").alias("n_rows")).join(
        found.agg(F.count("*").alias("n_in_source")))


def standings_fractional_points(spark, sf_dir):
    """Season standings of points with cents, computed from the tables on every read."""
    t = _t(spark, sf_dir)
    fact = silver.fact_results(t.results("l_extendedprice"), t.stored("dim_races"),
                               t.stored("dim_status"))
    return gold.constructor_standings(fact, t.stored("dim_constructors"))


def dash(view: str, source: str) -> Query:
    return lambda spark, sf_dir: getattr(dashboard, view)(_gold_table(spark, sf_dir, source))


def dash_top5_chosen_season(spark, sf_dir):
    return dashboard.top_n_of_season(_gold_table(spark, sf_dir, "constructor_standings"), RANGE_FROM)


def dash_top5_of_season(spark, sf_dir):
    standings = _gold_table(spark, sf_dir, "constructor_standings")
    return top_k_per_group(standings, "season_rank", 5)


QUERIES: dict[str, Query] = {
    # sources
    "csv_explicit_schema": csv_explicit_schema,
    "object_store_path": object_store_path,
    "csv_rejects": csv_rejects,
    "csv_infer_schema": csv_infer_schema,
    "normalize_null_markers": normalize_null_markers,
    # sinks
    "layer_roundtrip": layer_roundtrip,
    "overwrite_idempotent": overwrite_idempotent,
    "partitioned_overwrite": partitioned_overwrite,
    "layer_lifecycle": layer_lifecycle,
    "sql_readback": sql_readback_query,
    "schema_contract": schema_contract,
    # projections, casts, flags
    "project_rename": project_rename,
    "audit_column": audit_column,
    "cast_columns": cast_columns_query,
    "dim_circuits": _silver("dim_circuits"),
    "dim_drivers": _silver("dim_drivers"),
    "dim_constructors": _silver("dim_constructors"),
    "dim_status": _silver("dim_status"),
    "dim_races": _silver("dim_races"),
    "dim_full_name": dim_full_name,
    "finished_flag": _fact_flag("finished", "status_id"),
    "podium_flag": _fact_flag("is_podium", "finish_position"),
    "win_flag": _fact_flag("is_win", "finish_position"),
    # joins
    "fact_left_enrich": _silver("fact_results"),
    "standings_left_expr": _silver("fact_driver_standings"),
    "duplicate_keys": duplicate_result_keys,
    # aggregates
    "career_rollup": _gold("constructor_career"),
    "career_count_distinct": _gold("driver_career"),
    "conditional_counts": conditional_counts,
    "distinct_keys": distinct_keys_query,
    # windows
    "season_standings_dense_rank": _gold("constructor_standings"),
    "standings_fractional_points": standings_fractional_points,
    "entity_row_number": entity_row_number,
    "consecutive_streaks": _gold("constructor_dominance"),
    "driver_season_streaks": driver_season_streaks,
    "season_champions": _gold("season_champions"),
    "never_champion_ranked": _gold("drivers_without_title"),
    "season_range_filter": season_range_filter,
    # sorts, top-k, dashboard
    "topk_career": topk_career,
    "sorted_career": sorted_career,
    "sorted_standings": sorted_standings,
    "limit_preview": limit_preview,
    "dash_top10_drivers": dash("top10_drivers", "driver_career"),
    "dash_top10_constructors": dash("top10_constructors", "constructor_career"),
    "dash_champion_points": dash("champion_points", "season_champions"),
    "dash_uncrowned": dash("uncrowned", "drivers_without_title"),
    "dash_streaks": dash("streaks", "constructor_dominance"),
    "dash_top5_of_season": dash_top5_of_season,
    "dash_top5_chosen_season": dash_top5_chosen_season,
    "dash_top5_selected_season": dash("top_n_of_latest_season", "constructor_standings"),
}

QUERIES.update(robust.QUERIES)
