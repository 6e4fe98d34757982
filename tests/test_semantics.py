"""One test per semantic rule (nulls, ties, unmatched keys) on tiny inline frames."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import (clean_null_markers, conditional_count, finished_flag,
                                      full_name, podium_flag, win_flag)
from strata.operators.enrich import (assert_unique_keys, duplicate_keys, exclude_keys,
                                     inner_enrich, left_enrich, left_enrich_on)
from strata.operators.ranking import global_rank, rank_within, top_k
from strata.operators.snapshots import last_round_leaders
from strata.operators.streaks import consecutive_streaks
from strata.plans import gold, schemas
from strata.sinks.tables import ContractViolation, check_contract
from strata.sources.csv import (HeaderMismatch, check_header, ingest, read_csv_positional,
                                source_path)


def rows(df, *cols):
    df = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


# N1 / N2 / N4 / N5: positional CSV, PERMISSIVE, header check
def test_positional_csv_with_trailing_column(spark, tmp_path):
    path = tmp_path / "status.csv"
    path.write_bytes('statusId,status,source\r\n1,"Finished, really",a\r\nx,Lapped,b\r\n'
                     .encode())
    df = read_csv_positional(spark, str(path), schemas.raw_schema("status"))
    assert rows(df) == [(1, "Finished, really"), (None, "Lapped")]
    assert ingest(df, ["statusId"]).reject_count().first()["rejects"] == 1
    assert df.schema["statusId"].nullable                   # nullable=False has no effect


def test_header_check():
    schema = schemas.raw_schema("status")
    check_header(["statusId", "status", "source"], schema)
    with pytest.raises(HeaderMismatch):
        check_header(["status", "statusId"], schema)
    assert source_path("abfss://c@a.dfs.core.windows.net/raw/", "status").endswith(
        "/raw/status.csv")


# P7 / N3
def test_null_markers(spark):
    df = spark.createDataFrame([("\\N", "12"), ("3", "\\N"), ("x", None)], "a string, b string")
    out = clean_null_markers(df, {"a": "int", "b": None})
    assert rows(out) == [(3, None), (None, "12"), (None, None)]


# E1
def test_full_name_skips_null(spark):
    df = spark.createDataFrame([("Ayrton", "Senna"), (None, "Mansell")], "f string, s string")
    assert rows(df.select(full_name("f", "s"))) == [("Ayrton Senna",), ("Mansell",)]


# N6 / N7 / E2-E5
def test_flags(spark):
    df = spark.createDataFrame(
        [("Finished", 1), ("+1 Lap", 2), ("+12 Laps", 3), ("Lapped", 4), ("Accident", None),
         (None, 1), ("Did not start", 3), ("x+1 Lap", 2)], "s string, p int")
    out = df.select("s", finished_flag("s").alias("f"), podium_flag("p").alias("pod"),
                    win_flag("p").alias("w"))
    got = {(r.s, r.f, r.pod, r.w) for r in out.collect()}
    assert ("Finished", True, True, True) in got
    assert ("+1 Lap", True, True, False) in got
    assert ("+12 Laps", True, True, False) in got
    assert ("Lapped", False, False, False) in got
    assert ("Accident", False, None, None) in got           # null position -> null flags
    assert (None, False, True, True) in got                 # unknown status -> False
    assert ("x+1 Lap", False, True, False) in got           # anchored at the start


# A3: conditional count is null (not 0) for an all-null group
def test_conditional_count_all_null_group(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, True), (2, False)], "k int, f boolean")
    assert rows(df.groupBy("k").agg(conditional_count("f").alias("n"))) == [(1, None), (2, 1)]


# N8 / N9 / N10 / N11 / J4
def test_join_semantics(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99)], "id int, race_id int")
    races = spark.createDataFrame([(10, 2001)], "race_id int, race_year int")
    assert rows(left_enrich(fact, races, "race_id"), "id", "race_year") == [(1, 2001), (2, None)]
    assert rows(inner_enrich(fact, races, "race_id"), "id") == [(1,)]
    st = spark.createDataFrame([(1, 10), (2, 99)], "sid int, raceId int")
    joined = left_enrich_on(st, races, "raceId", "race_id", ["race_year"])
    assert rows(joined, "sid", "race_id") == [(1, 10), (2, None)]
    dup = spark.createDataFrame([(10, 2001), (10, 2002)], "race_id int, race_year int")
    assert rows(duplicate_keys(dup, "race_id")) == [(10, 2)]
    with pytest.raises(ValueError):
        assert_unique_keys(dup, "race_id")
    assert rows(exclude_keys(fact, races, "race_id"), "id") == [(2,)]


# N12 / N13 dense_rank vs rank
def test_rank_ties(spark):
    df = spark.createDataFrame([(2001, "a", 10.0), (2001, "b", 10.0), (2001, "c", 5.0)],
                               "y int, t string, p double")
    assert rows(rank_within(df, ["y"], "p", "r"), "t", "r") == [("a", 1), ("b", 1), ("c", 2)]
    ranked = global_rank(df, "p", "r", "rank")
    assert rows(ranked, "t", "r") == [("a", 1), ("b", 1), ("c", 3)]


# N14 / N15
def test_streaks(spark):
    df = spark.createDataFrame([(1, "F", 2001), (1, "F", 2002), (1, "F", 2004), (2, "M", 2003),
                                (3, "W", None), (3, "W", 2005), (3, "W", 2006), (3, "W", 2007)],
                               "id int, name string, y int")
    out = consecutive_streaks(df, ["id", "name"], "y")
    assert rows(out) == [(1, "F", 2001, 2002, 2), (3, "W", 2005, 2007, 3)]


# N16
def test_last_round_leaders(spark):
    df = spark.createDataFrame(
        [(2001, 1, 1, "a"), (2001, 2, 1, "b"), (2001, 2, 2, "a"),
         (2002, 1, 1, "a"), (2002, 1, 1, "b"),
         (2003, 1, 1, "a"), (2003, 2, 2, "b"),
         (None, 1, 1, "z")], "y int, r int, pos int, d string")
    out = last_round_leaders(df, "y", "r", "pos")
    assert rows(out, "y", "d") == [(2001, "b"), (2002, "a"), (2002, "b"), (None, "z")]


# N18: no wins or null wins -> not ranked
def test_drivers_without_title_needs_wins(spark):
    career = spark.createDataFrame([(1, "a", 0, 1.0), (2, "b", None, 2.0), (3, "c", 2, 3.0),
                                    (4, "d", 5, 4.0)],
                                   "driver_id int, full_name string, total_wins int, "
                                   "total_points double")
    champions = spark.createDataFrame([(2001, 4, "d", 1.0)],
                                      "race_year int, driver_id int, full_name string, "
                                      "champion_points double")
    out = gold.drivers_without_title(career, champions)
    assert rows(out) == [(3, "c", 2, 3.0, 1)]


# N19: narrowing sums raise on overflow under ANSI
def test_int_narrowing_overflow_raises(spark):
    df = spark.createDataFrame([(True,)] * 2, "f boolean").selectExpr("2147483647 AS big")
    with pytest.raises(Exception):
        df.agg(F.sum("big").cast("int")).collect()


# K5 contract
def test_contract(spark):
    df = spark.createDataFrame([(1, "x")], "status_id int, status_description string")
    check_contract(df, schemas.silver_schema("dim_status"))
    with pytest.raises(ContractViolation):
        check_contract(df.select("status_description", "status_id"),
                       schemas.silver_schema("dim_status"))


# O3: top-k with a key tie-break is deterministic
def test_top_k_ties(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, w int")
    out = top_k(df, [F.col("w").desc(), F.col("id")], 4)
    assert [r.id for r in out.collect()] == [2, 5, 8, 11]


# N22: a table cannot be overwritten while it is read
def test_self_overwrite_is_rejected(spark, tmp_path):
    from strata.sinks.tables import create_layer, drop_layer, overwrite_table
    create_layer(spark, "selfread", str(tmp_path / "selfread"))
    overwrite_table(spark.range(3).toDF("id"), "selfread.t")
    with pytest.raises(Exception):
        overwrite_table(spark.table("selfread.t"), "selfread.t")
    drop_layer(spark, "selfread")


def test_types_are_int_for_counts(spark):
    df = spark.createDataFrame([(1, True, 1)], "k int, f boolean, r int")
    out = df.groupBy("k").agg(conditional_count("f").alias("n"))
    assert out.schema["n"].dataType == T.IntegerType()


# K4 / K6 / K7 / K8: layer namespaces
def test_layer_lifecycle(spark, tmp_path):
    from strata.plans.pipeline import PipelineConfig, create_layers, reset_layers
    from strata.sinks.tables import current_namespace, overwrite_table, use_layer
    config = PipelineConfig(env="prod", catalog_base="life", warehouse_root=str(tmp_path))
    create_layers(spark, config)
    use_layer(spark, config.database("gold"))
    assert current_namespace(spark) == ("spark_catalog", "life_prod_gold")
    from strata.sinks.tables import list_layers
    assert sorted(list_layers(spark, "life_prod_*")) == [
        "life_prod_bronze", "life_prod_gold", "life_prod_silver"]
    overwrite_table(spark.range(2).toDF("id"), config.table("gold", "driver_career"))
    use_layer(spark, "default")
    reset_layers(spark, config)
    names = {d.name for d in spark.catalog.listDatabases()}
    assert not {"life_prod_bronze", "life_prod_silver", "life_prod_gold"} & names
    assert not (tmp_path / "life_prod_gold" / "driver_career").exists()


# A6: the approximate distinct count is an opt-in scale option
def test_approximate_distinct_option(spark):
    from strata.plans import gold
    fact = spark.createDataFrame(
        [(1, r, 1.0, True, True, 2001) for r in range(50)] + [(2, 7, 2.0, False, True, 2002)],
        "driver_id int, race_id int, points double, is_win boolean, is_podium boolean, "
        "race_year int")
    drivers = spark.createDataFrame([(1, "A", "x"), (2, "B", "y")],
                                    "driver_id int, full_name string, nationality string")
    exact = {r.driver_id: r.races_disputed for r in gold.driver_career(fact, drivers).collect()}
    approx = {r.driver_id: r.races_disputed
              for r in gold.driver_career(fact, drivers, approximate_distinct=True).collect()}
    assert exact == {1: 50, 2: 1}
    assert approx[2] == 1 and abs(approx[1] - 50) <= 2


# S2: profiling infers types on a sample and never loads data with them
def test_profile_csv(spark, tmp_path):
    from strata.sources.csv import profile_csv
    path = tmp_path / "races.csv"
    path.write_text("raceId,year,name\n1,2001,A\n2,2002,B\n")
    schema = profile_csv(spark, str(path), sampling_ratio=1.0)
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [
        ("raceId", "int"), ("year", "int"), ("name", "string")]


# K2 / K3: a static overwrite of a partitioned table replaces every partition
def test_partitioned_overwrite_replaces_all_partitions(spark, tmp_path):
    from strata.sinks.tables import create_layer, drop_layer, overwrite_table
    create_layer(spark, "kparts", str(tmp_path / "kparts"))
    first = spark.createDataFrame([(1, 2001), (2, 2002)], "id int, race_year int")
    overwrite_table(first, "kparts.t", partition_by=["race_year"])
    second = spark.createDataFrame([(3, 2003)], "id int, race_year int")
    overwrite_table(second, "kparts.t", partition_by=["race_year"])
    assert rows(spark.table("kparts.t"), "id", "race_year") == [(3, 2003)]
    drop_layer(spark, "kparts")


# checked broadcast: within the bound -> hinted broadcast; above it -> unchanged
def test_broadcast_if_small(spark):
    """The measured side joins alike, broadcast or not (plans: tests/test_plans.py)."""
    from strata.operators.enrich import broadcast_if_small
    big, side = spark.range(0, 2000).toDF("k"), spark.range(0, 5).toDF("k")
    for limit in (1, 1 << 20):
        assert big.join(broadcast_if_small(side, max_bytes=limit), "k").count() == 5


# S1 / N1: every file of a folder is held against the header
def test_header_of_every_file(spark, tmp_path):
    from strata.sources.csv import header_errors
    folder = tmp_path / "status.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("statusId,status,source\n1,Finished,x\n")
    (folder / "b.csv").write_text("statusId,status,source\n2,Lapped,x\n")
    schema = schemas.raw_schema("status")
    assert rows(read_csv_positional(spark, str(folder), schema)) == [(1, "Finished"), (2, "Lapped")]
    (folder / "c.csv").write_text("statusId,source,status\n3,x,Lapped\n")
    with pytest.raises(HeaderMismatch), header_errors():
        read_csv_positional(spark, str(folder), schema).collect()


# S3: 64-bit keys from the raw reader on
def test_wide_keys(spark, tmp_path):
    path = tmp_path / "races.csv"
    path.write_text("raceId,year,round,circuitId,name,date,time,url\n"
                    "3000000000,2001,1,4000000000,A,2001-01-01,,u\n")
    wide = read_csv_positional(spark, str(path), schemas.raw_schema("races", T.LongType()))
    assert rows(wide, "raceId", "circuitId") == [(3000000000, 4000000000)]
    for entity in schemas.RAW_COLUMNS:
        own, foreign = schemas.bronze_keys(entity)
        bronze = schemas.bronze_schema(entity, T.LongType())
        for key in own + foreign:
            expected = T.IntegerType() if key in ("statusId", "status_id") else T.LongType()
            assert bronze[key].dataType == expected


# one session for every launch
def test_shared_folder_is_required_off_local():
    from strata.session import is_local
    assert is_local("local") and is_local("local[8]")
    assert not is_local("local-cluster[2,1,1024]") and not is_local("yarn") and not is_local("spark://h:7077")
