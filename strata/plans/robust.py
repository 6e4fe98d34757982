"""Queries on skewed keys, exact sums, damaged files, key audits, sketches and refreshes.

They read the whole test tables like those of ``queries.py``; the skew, the damage and the moved
columns are derived from the tables by Spark. Each has DuckDB SQL beside it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.audit import key_audit
from strata.operators.rollups import exact_range, exact_sum
from strata.operators.skew import left_enrich_skewed
from strata.operators.sketches import distinct_sketches, merged_distinct
from strata.operators.streaks import consecutive_streaks, with_row_number
from strata.plans.pipeline import LAYERS, PipelineConfig, create_layers, reset_layers
from strata.session import scratch_path, store
from strata.sinks.clustered import row_groups, write_clustered
from strata.sinks.tables import ContractViolation, create_layer, list_layers, overwrite_table
from strata.sinks.versions import refresh_table, versions
from strata.sources.csv import null_causes, read_csv_by_header, read_csv_lanes
from strata.sources.profile import column_counts, merge_counts, read_text_columns, with_types
from strata.sources.standins import StandInTables
from strata.sources.tables import read_table

# Rows of one window task in the hot-entity queries: small, so that the entity spans many.
SLICE = 1000


def _t(spark: SparkSession, sf_dir: str) -> StandInTables:
    return StandInTables.of(spark, sf_dir)


# ---- hot entities and keys ---------------------------------------------------------
def _hot_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders as (entity, seq): one entity has a third of them, the others one customer each."""
    o = _t(spark, sf_dir).table("orders").where("o_orderstatus <> 'P'")
    hot = F.col("o_orderkey") % 3 == 0
    return o.select(F.when(hot, -1).otherwise(F.col("o_custkey")).cast("bigint").alias("entity"),
                    F.col("o_orderkey").alias("seq"))


def hot_entity_row_number(spark, sf_dir):
    return with_row_number(_hot_entities(spark, sf_dir), ["entity"], "seq", slice_rows=SLICE)


def hot_entity_streaks(spark, sf_dir):
    """Runs of the hot entity's orders, one in three, as consecutive numbers; the others' orders
    in steps of a hundred."""
    rows = _hot_entities(spark, sf_dir)
    rows = rows.withColumn("seq", F.when(F.col("entity") == -1, F.expr("seq div 3")).otherwise(F.expr("seq div 100")))
    return consecutive_streaks(rows.distinct(), ["entity"], "seq", slice_rows=SLICE)


def hot_key_left_join(spark, sf_dir):
    """Results of which a good part belongs to one race and some to none, with their race."""
    t = _t(spark, sf_dir)
    first = t.table("orders").where("o_orderstatus <> 'P'").agg(F.min("o_orderkey")).first()[0]
    line = F.col("l_linenumber")
    fact = t.table("lineitem").select(
        (F.col("l_orderkey") * 8 + line).alias("result_id"),
        F.when(line <= 2, first).when(line < 7, F.col("l_orderkey")).cast("bigint").alias("race_id"))
    return left_enrich_skewed(fact, t.stored("dim_races"), "race_id", ["race_year", "race_name"])


# ---- exact sums --------------------------------------------------------------------
def _extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices from about 1e-9 to 1e15, of both signs, by supplier."""
    li = _t(spark, sf_dir).table("lineitem")
    price, turn = F.col("l_extendedprice").cast("double"), F.col("l_linenumber") % 3
    size = F.when(turn == 0, F.floor(price) * F.lit(2.0 ** -40)).when(turn == 1, price * F.lit(1e10)).otherwise(price)
    return li.select(F.col("l_suppkey").alias("constructor_id"),
                     F.when(F.col("l_returnflag") == "R", -size).otherwise(size).alias("points"))


def exact_sum_extremes(spark, sf_dir):
    rows = _extremes(spark, sf_dir)
    return rows.groupBy("constructor_id").agg(exact_sum("points").alias("total_points"))


def exact_sum_measured(spark, sf_dir):
    """The same by bounds measured on the values, the rows in another order."""
    rows = _extremes(spark, sf_dir)
    bounds = exact_range(rows, "points")
    return rows.repartition(7, F.xxhash64("points")).groupBy("constructor_id").agg(
        exact_sum("points", *bounds).alias("total_points"))


# ---- CSV: profile, damaged values, moved columns -------------------------------------
DAMAGED = T.StructType([T.StructField("raceId", T.LongType()), T.StructField("year", T.IntegerType()),
                        T.StructField("circuitId", T.LongType()), T.StructField("name", T.StringType()),
                        T.StructField("date", T.DateType())])


def _export(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw race rows of text: some keys, years and dates do not parse, some years and
    circuits are not there."""
    key = F.col("o_orderkey")
    text = lambda c: F.col(c).cast("string")
    return _t(spark, sf_dir).table("orders").select(
        F.when(key % 41 == 0, F.concat(F.lit("x"), key)).otherwise(key.cast("string")).alias("raceId"),
        F.when(key % 50 == 0, "n/a").when(key % 50 != 1, F.year("o_orderdate").cast("string")).alias("year"),
        F.when(key % 31 == 0, "\\N").when(key % 31 != 1, text("o_custkey")).alias("circuitId"),
        F.col("o_orderpriority").alias("name"),
        F.when(key % 70 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.lit("testdata").alias("source"))


def _lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(read_csv_lanes(spark, _export(_damaged(spark, sf_dir), "damaged-csv"), DAMAGED), "csv-lanes")


def csv_corrupt_lane(spark, sf_dir):
    """Records with a value that does not parse, as they stand in the file."""
    return _lanes(spark, sf_dir).where("_raw_line is not null").select(
        "raceId", "year", "circuitId", "date", F.col("_raw_line").alias("raw_line"),
        F.array_join("_unparsed", ",").alias("unparsed"))


def csv_null_causes(spark, sf_dir):
    return null_causes(_lanes(spark, sf_dir))


def csv_profile(spark, sf_dir):
    """Counts and type of every column, from the profiles of two exports put together."""
    rows = _damaged(spark, sf_dir)
    odd = F.regexp_extract("raceId", r"(\d+)", 1).cast("bigint") % 2 == 1
    parts = [_export(rows.where(odd), "profile-odd"), _export(rows.where(~odd), "profile-even")]
    counts = merge_counts(*[column_counts(read_text_columns(spark, p), ("\\N",)) for p in parts])
    return with_types(counts).drop("position")


def csv_moved_columns(spark, sf_dir):
    """Three exports of one entity: as declared, with columns moved, with columns added."""
    o = _t(spark, sf_dir).table("orders").select(
        F.col("o_orderkey").alias("raceId"), F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("circuitId"),
        F.concat_ws(", ", "o_orderpriority", "o_orderstatus").alias("name"), F.to_date("o_orderdate").alias("date"))
    third = F.col("raceId") % 3
    paths = [_export(o.where(third == 0), "moved-0"),
             _export(o.where(third == 1).select("date", "name", "raceId", "circuitId", "year"), "moved-1"),
             _export(o.where(third == 2).select("raceId", F.lit("added, here").alias("notes"), "year", "circuitId", "name",
                                                F.lit(1.5).alias("fee"), "date"), "moved-2")]
    return read_csv_by_header(spark, paths, DAMAGED)


# ---- audit, sketches ---------------------------------------------------------------
def key_audit_query(spark, sf_dir):
    """All keys of the results, which name races that are not there, against their dimensions."""
    t = _t(spark, sf_dir)
    status = t.bronze("status")
    return key_audit(t.bronze("results"), ["result_id"], {
        "race_id": (t.bronze("races"), "race_id"), "driver_id": (t.bronze("drivers"), "driver_id"),
        "constructor_id": (t.bronze("constructors"), "constructor_id"),
        # a dimension whose first key stands twice
        "status_id": (status.unionByName(status.where("statusId = 1")), "statusId")})


def career_distinct_sketches(spark, sf_dir):
    """Races per driver from sketches stored per season: the exact number, and whether the
    estimate lies within 2 % of it."""
    fact = _t(spark, sf_dir).stored("fact_results")
    sketches = store(distinct_sketches(fact, ["driver_id"], "race_year", "race_id"), "season-sketches")
    exact = fact.groupBy("driver_id").agg(F.count_distinct("race_id").alias("races"))
    near = F.abs(F.col("estimate") - F.col("races")) <= 0.02 * F.col("races")
    return exact.join(merged_distinct(sketches, ["driver_id"], "estimate"), "driver_id").select(
        "driver_id", "races", near.alias("within_bound"))


# ---- refreshes and layers ------------------------------------------------------------
def versioned_refresh(spark, sf_dir):
    """Three refreshes, then one that breaks the contract and one whose check refuses the
    rows: the third one's rows are read, from the latest of two versions that are left."""
    t = _t(spark, sf_dir)
    location = scratch_path(spark, "versioned")
    db = f"strata_versioned_{location.rsplit('-', 1)[-1][:12]}"
    create_layer(spark, db, f"{location}/db")
    races, table, folder = t.silver["dim_races"], f"{db}.dim_races", f"{location}/dim_races"
    refresh_table(races.limit(0), table, folder, partition_by=["race_year"], contract=races.schema)
    refresh_table(races.where("round < 9"), table, folder, partition_by=["race_year"], contract=races.schema)
    refresh_table(races, table, folder, partition_by=["race_year"], contract=races.schema)
    refused = 0
    for rows, check in ((races.drop("round"), None), (races.where("round < 0"), _not_empty)):
        try:
            refresh_table(rows, table, folder, contract=races.schema, check=check)
        except (ContractViolation, ValueError):
            refused += 1
    return read_table(spark, table).withColumns({
        "refused": F.lit(refused), "versions_left": F.lit(len(versions(spark, folder)))})


def _not_empty(rows: DataFrame) -> None:
    if rows.isEmpty():
        raise ValueError("no rows")


def layers_reset(spark, sf_dir):
    """Three layers filled with tables of the pipeline's names, then reset: what they held, and
    what is left."""
    t = _t(spark, sf_dir)
    root = scratch_path(spark, "reset")
    config = PipelineConfig(catalog_base=f"strata_reset_{root.rsplit('-', 1)[-1][:12]}", warehouse_root=root)
    tables = {"bronze": [("circuits", t.bronze("circuits")), ("status", t.bronze("status"))],
              "silver": [("dim_races", t.silver["dim_races"])],
              "gold": [("constructor_career", t.gold("constructor_career"))]}
    create_layers(spark, config)
    held = []
    for layer in LAYERS:
        for name, df in tables[layer]:
            overwrite_table(df, config.table(layer, name))
        held.append([read_table(spark, config.table(layer, name)).agg(F.count("*").alias("n")) for name, _ in tables[layer]])
    rows = None
    for layer, counts in zip(LAYERS, held):
        total = sum(c.first().n for c in counts)
        one = spark.range(1).select(F.lit(layer).alias("layer"), F.lit(len(counts)).alias("tables"),
                                    F.lit(total).cast("bigint").alias("rows"))
        rows = one if rows is None else rows.unionByName(one)
    reset_layers(spark, config)
    left = [layer for layer in LAYERS if list_layers(spark, config.database(layer))]
    return rows.withColumn("layers_left", F.lit(len(left)))


CLUSTER_FROM, CLUSTER_TO = 100, 110


def clustered_write(spark, sf_dir):
    """Results of a few drivers, read from files clustered by driver, and whether these take at most
    a quarter of the row groups that files in the order of loading take."""
    fact = _t(spark, sf_dir).stored("fact_results")
    plain, near = scratch_path(spark, "unclustered"), scratch_path(spark, "clustered")
    fact.repartition(16).write.parquet(plain)
    write_clustered(fact, near, ["driver_id", "race_id"], files=16)
    read = lambda path: row_groups(spark, path, "driver_id", CLUSTER_FROM, CLUSTER_TO)[0]
    rows = spark.read.parquet(near).where(F.col("driver_id").between(CLUSTER_FROM, CLUSTER_TO))
    return rows.withColumn("fewer_row_groups", F.lit(4 * read(near) <= read(plain)))


QUERIES = {
    "clustered_write": clustered_write,
    "hot_entity_row_number": hot_entity_row_number,
    "hot_entity_streaks": hot_entity_streaks,
    "hot_key_left_join": hot_key_left_join,
    "exact_sum_extremes": exact_sum_extremes,
    "exact_sum_measured": exact_sum_measured,
    "csv_profile": csv_profile,
    "csv_corrupt_lane": csv_corrupt_lane,
    "csv_null_causes": csv_null_causes,
    "csv_moved_columns": csv_moved_columns,
    "key_audit": key_audit_query,
    "career_distinct_sketches": career_distinct_sketches,
    "versioned_refresh": versioned_refresh,
    "layers_reset": layers_reset,
}


# ---- reference SQL -------------------------------------------------------------------
_OPEN = "FROM orders WHERE o_orderstatus <> 'P'"
_ENTITIES = f"""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS entity, o_orderkey AS seq {_OPEN}"""

# values * 2**43 are integers; quotient and remainder by 2**53 are doubles, so one addition rounds
EXACT = """(CAST(s // 9007199254740992 AS DOUBLE) * 9007199254740992.0 + CAST(s % 9007199254740992 AS DOUBLE))
       / 8796093022208.0"""
_EXTREMES = f"""
SELECT constructor_id, {EXACT} AS total_points
FROM (SELECT l_suppkey AS constructor_id, sum(CAST(
        CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END *
        CASE l_linenumber % 3 WHEN 0 THEN floor(CAST(l_extendedprice AS DOUBLE)) * {2.0 ** -40!r}
             WHEN 1 THEN CAST(l_extendedprice AS DOUBLE) * 1e10 ELSE CAST(l_extendedprice AS DOUBLE) END
        * 8796093022208.0 AS HUGEINT)) AS s
      FROM lineitem GROUP BY 1)"""

_DAMAGED_ROWS = """
raw AS (
  SELECT CASE WHEN o_orderkey % 41 = 0 THEN 'x' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS raceId,
         CASE o_orderkey % 50 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year,
         CASE o_orderkey % 31 WHEN 0 THEN '\\N' WHEN 1 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS circuitId,
         o_orderpriority AS name,
         CASE WHEN o_orderkey % 70 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
         'testdata' AS source FROM orders)"""
_DAMAGED_SQL = f"""
WITH {_DAMAGED_ROWS},
typed AS (
  SELECT *, TRY_CAST(raceId AS BIGINT) AS r, TRY_CAST(year AS INTEGER) AS y, TRY_CAST(circuitId AS BIGINT) AS c,
         TRY_CAST(date AS DATE) AS d FROM raw),
lanes AS (
  SELECT *, raceId IS NOT NULL AND r IS NULL AS br, year IS NOT NULL AND y IS NULL AS "by",
         circuitId IS NOT NULL AND c IS NULL AS bc, date IS NOT NULL AND d IS NULL AS bd FROM typed)"""


def _profile_sql() -> str:
    parts = []
    for name in ("raceId", "year", "circuitId", "name", "date", "source"):
        x = f'"{name}"'
        whole = f"regexp_full_match({x}, '[+-]?[0-9]+')"
        parts.append(f"""
SELECT '{name}' AS "column", count(*) AS rows, count(*) - count({x}) AS nulls,
       count(*) FILTER ({x} = '\\N') AS markers, count(*) FILTER ({whole} AND TRY_CAST({x} AS INTEGER) IS NOT NULL) AS ints,
       count(*) FILTER ({whole} AND TRY_CAST({x} AS BIGINT) IS NOT NULL) AS bigints, CAST(0 AS BIGINT) AS wide_bigints,
       count(*) FILTER ({whole}) AS doubles,
       count(*) FILTER (regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) AS dates,
       CAST(0 AS BIGINT) AS timestamps FROM raw""")
    return f"""
WITH {_DAMAGED_ROWS},
c AS ({' UNION ALL '.join(parts)})
SELECT *, CASE WHEN rows = nulls THEN 'string' WHEN ints = rows - nulls THEN 'int' WHEN bigints = rows - nulls THEN 'bigint'
               WHEN dates = rows - nulls THEN 'date' ELSE 'string' END AS type FROM c"""


def _audit_sql() -> str:
    keys = {"race_id": "SELECT CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END AS k FROM orders",
            "driver_id": "SELECT c_custkey AS k FROM customer", "constructor_id": "SELECT s_suppkey AS k FROM supplier",
            "status_id": "SELECT k FROM (SELECT DISTINCT CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS k FROM orders) "
                         "UNION ALL SELECT DISTINCT 1 FROM orders WHERE substring(o_orderpriority, 1, 1) = '1'"}
    parts = [f"""
SELECT '{key}' AS key, count(*) AS rows, CAST(0 AS BIGINT) AS null_rows,
       count(DISTINCT {key}) FILTER ({key} NOT IN (SELECT k FROM ({dim}))) AS orphan_keys,
       count(*) FILTER ({key} NOT IN (SELECT k FROM ({dim}))) AS orphan_rows,
       (SELECT count(*) FROM (SELECT k FROM ({dim}) GROUP BY k HAVING count(*) > 1)) AS duplicate_keys FROM r"""
             for key, dim in keys.items()]
    return f"""
WITH r AS (
  SELECT l_orderkey * 8 + l_linenumber AS result_id, l_orderkey AS race_id, o_custkey AS driver_id,
         l_suppkey AS constructor_id, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS status_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
{' UNION ALL '.join(parts)}
UNION ALL
SELECT 'result_id', count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT),
       (SELECT count(*) FROM (SELECT result_id FROM r GROUP BY 1 HAVING count(*) > 1)) FROM r"""


def oracle(with_ctes: Callable[..., str]) -> dict[str, str]:
    """SQL of this module's queries; ``with_ctes`` puts the tables of the other layers before it."""
    return {
        "hot_entity_row_number": f"""
SELECT entity, seq, CAST(row_number() OVER (PARTITION BY entity ORDER BY seq) AS INTEGER) AS row_number
FROM ({_ENTITIES})""",
        "hot_entity_streaks": f"""
WITH e AS (SELECT DISTINCT entity, CASE WHEN entity = -1 THEN seq // 3 ELSE seq // 100 END AS seq
           FROM ({_ENTITIES})),
n AS (SELECT entity, seq, seq - row_number() OVER (PARTITION BY entity ORDER BY seq) AS run FROM e)
SELECT entity, min(seq) AS streak_start_year, max(seq) AS streak_end_year, CAST(count(*) AS INTEGER) AS streak_length
FROM n GROUP BY entity, run HAVING count(*) >= 2""",
        "hot_key_left_join": with_ctes(f"""
SELECT f.race_id, f.result_id, d.race_year, d.race_name
FROM (SELECT l_orderkey * 8 + l_linenumber AS result_id,
             CASE WHEN l_linenumber <= 2 THEN (SELECT min(o_orderkey) {_OPEN}) WHEN l_linenumber < 7 THEN l_orderkey END
               AS race_id FROM lineitem) f
LEFT JOIN dim_races d ON f.race_id = d.race_id""", "dim_races"),
        "exact_sum_extremes": _EXTREMES,
        "exact_sum_measured": _EXTREMES,
        "csv_profile": _profile_sql(),
        "csv_corrupt_lane": _DAMAGED_SQL + """
SELECT r AS "raceId", y AS year, c AS "circuitId", d AS date,
       concat(raceId, ',', year, ',', circuitId, ',', name, ',', date, ',', source) AS raw_line,
       concat_ws(',', CASE WHEN br THEN 'raceId' END, CASE WHEN "by" THEN 'year' END,
                 CASE WHEN bc THEN 'circuitId' END, CASE WHEN bd THEN 'date' END) AS unparsed
FROM lanes WHERE br OR "by" OR bc OR bd""",
        "csv_null_causes": _DAMAGED_SQL + " UNION ALL ".join(f"""
SELECT '{name}' AS "column", count(*) FILTER ("{name}" IS NULL) AS null_in_file, {bad} AS null_by_parse FROM lanes"""
                                                               for name, bad in (
            ("raceId", "count(*) FILTER (br)"), ("year", 'count(*) FILTER ("by")'), ("circuitId", "count(*) FILTER (bc)"),
            ("name", "CAST(0 AS BIGINT)"), ("date", "count(*) FILTER (bd)"))),
        "csv_moved_columns": """
SELECT o_orderkey AS "raceId", CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey AS "circuitId",
       concat_ws(', ', o_orderpriority, o_orderstatus) AS name, CAST(o_orderdate AS DATE) AS date FROM orders""",
        "key_audit": _audit_sql(),
        "career_distinct_sketches": with_ctes("""
SELECT driver_id, count(DISTINCT race_id) AS races, TRUE AS within_bound FROM fact_results GROUP BY driver_id""",
                                              "fact_results"),
        "versioned_refresh": with_ctes("SELECT *, 2 AS refused, 2 AS versions_left FROM dim_races", "dim_races"),
        "clustered_write": with_ctes(f"""
SELECT *, TRUE AS fewer_row_groups FROM fact_results WHERE driver_id BETWEEN {CLUSTER_FROM} AND {CLUSTER_TO}""",
                                     "fact_results"),
        "layers_reset": with_ctes("""
SELECT 'bronze' AS layer, 2 AS tables,
       (SELECT count(*) FROM b_circuits) + (SELECT count(*) FROM b_status) AS rows, 0 AS layers_left
UNION ALL SELECT 'silver', 1, (SELECT count(*) FROM dim_races), 0
UNION ALL SELECT 'gold', 1, (SELECT count(*) FROM constructor_career), 0""",
                                  "b_circuits", "b_status", "dim_races", "constructor_career"),
    }
