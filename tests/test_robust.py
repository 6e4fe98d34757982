"""Hot keys, damaged and moved files, audits, sketches and refreshes that fail."""

import os
import statistics
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.audit import DuplicateKeys, assert_single_dimension_keys, key_audit
from strata.operators.skew import heavy_keys, left_enrich_skewed
from strata.operators.sketches import distinct_sketches, merged_distinct
from strata.session import store
from strata.sinks.tables import ContractViolation, create_layer
from strata.sinks.versions import refresh_table, versions
from strata.sources.csv import (HeaderMismatch, null_causes, profile_csv, read_csv_by_header, read_csv_lanes,
                                read_csv_positional)
from strata.sources.profile import column_counts, merge_counts, with_types


# ---- hot foreign keys --------------------------------------------------------------
def hot_fact(spark, rows=60_000):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 != 1, F.col("id") % 5000)
    return store(spark.range(rows, numPartitions=8).select("id", key.cast("int").alias("k")), "hot-fact")


def test_skewed_join_equals_left_join(spark):
    fact = hot_fact(spark)
    dim = spark.range(3000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"), F.lit(1).alias("w"))
    assert heavy_keys(fact, "k", 0.1) == [7]
    ours, plain = left_enrich_skewed(fact, dim, "k", ["v"], share=0.1), fact.join(dim.select("k", "v"), "k", "left")
    assert ours.columns == plain.columns
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0
    none = left_enrich_skewed(fact.where("k % 2 = 0 and k <> 7"), dim, "k", ["v"], share=0.1)
    assert none.count() == fact.where("k % 2 = 0 and k <> 7").count()


def test_skewed_join_has_even_tasks(spark):
    fact = hot_fact(spark)
    dim = spark.range(5000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        near = left_enrich_skewed(fact, dim, "k", ["v"], share=0.1)
        sizes = [r["count"] for r in near.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * statistics.median(sizes)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plain = [r["count"] for r in fact.join(dim, "k", "left").groupBy(F.spark_partition_id()).count().collect()]
        assert max(plain) > 2 * statistics.median(plain)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


# ---- profile -----------------------------------------------------------------------
def test_profile_types_hold_every_value(spark):
    rows = [("1", "1", "1", "1.5", "2020-01-02", "2020-01-02 03:04:05", "x", None, "9007199254740993", " 1", "2020")] * 5 + \
        [("-7", "3000000000", "2", "1e3", "2021-02-03", "2020-01-02 03:04:06", "", None, "0.5", "2", "2021")]
    names = ["i", "b", "d", "f", "day", "ts", "s", "none", "wide", "space", "year"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    df = df.withColumn("d", F.when(F.col("i") == "-7", "2.25").otherwise(F.col("d")))
    types = {r["column"]: r["type"] for r in with_types(column_counts(df)).collect()}
    assert types == {"i": "int", "b": "bigint", "d": "double", "f": "double", "day": "date", "ts": "timestamp",
                     "s": "string", "none": "string", "wide": "string", "space": "string", "year": "int"}


def test_profiles_merge(spark):
    a = spark.createDataFrame([("1",), ("\\N",)], "x string")
    b = spark.createDataFrame([("2.5",), (None,)], "x string")
    counts = [column_counts(d, ("\\N",)) for d in (a, b)]
    whole = column_counts(a.union(b), ("\\N",))
    assert merge_counts(*counts).collect() == whole.select(*merge_counts(*counts).columns).collect()
    assert with_types(merge_counts(*counts), markers_are_null=True).first()["type"] == "double"
    assert with_types(merge_counts(*counts)).first()["type"] == "string"


def test_profiled_load_makes_no_nulls(spark, tmp_path):
    """The only value that is no number stands far behind any sample."""
    path = str(tmp_path / "a.csv")
    with open(path, "w") as out:
        out.write("k,v\n" + "".join(f"{i},{i}\n" for i in range(20_000)) + "x1,1.5\n")
    schema = profile_csv(spark, path)
    assert [f.dataType for f in schema] == [T.StringType(), T.DoubleType()]
    assert read_csv_positional(spark, path, schema).where("k is null or v is null").count() == 0


# ---- damaged values ----------------------------------------------------------------
SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.DoubleType()),
                       T.StructField("name", T.StringType()), T.StructField("day", T.DateType())])


def test_lanes_tell_causes_of_nulls(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w") as out:
        out.write('id,n,name,day,source\n1,2.5,"a, b",2020-01-01,x\n,,,,x\nx2,n/a,c,2020-01-02,x\n3,\\N,"q, r",soon,x\n')
    lanes = store(read_csv_lanes(spark, path, SCHEMA), "lanes")
    rows = {r._raw_line: r for r in lanes.collect()}
    bad = rows['3,\\N,"q, r",soon,x']
    assert bad.id == 3 and bad.name == "q, r" and bad._unparsed == ["n", "day"]
    assert rows["x2,n/a,c,2020-01-02,x"]._unparsed == ["id", "n"] and len(rows) == 3 and lanes.count() == 4
    causes = {r["column"]: (r.null_in_file, r.null_by_parse) for r in null_causes(lanes).collect()}
    assert causes == {"id": (1, 1), "n": (1, 2), "name": (1, 0), "day": (1, 1)}
    marked = store(read_csv_lanes(spark, path, SCHEMA, null_value="\\N"), "lanes")
    assert {r["column"]: r.null_by_parse for r in null_causes(marked).collect()}["n"] == 1


def test_record_over_several_lines(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w") as out:
        out.write('id,n,name,day\n1,2.5,"two\nlines",2020-01-01\n')
    rows = read_csv_positional(spark, path, SCHEMA, multi_line=True).collect()
    assert len(rows) == 1 and rows[0].name == "two\nlines"


# ---- moved columns -----------------------------------------------------------------
def test_files_are_read_by_their_headers(spark, tmp_path):
    texts = {"a.csv": "id,n,name,day\n1,1.5,x,2020-01-01\n", "b.csv": "day,name,extra,n,id\n2020-01-02,y,z,2.5,2\n",
             "c.csv": "﻿id,n,,name,day,,extra,extra\n3,3.5,,w,2020-01-03,,1,2\n", "empty.csv": ""}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "_SUCCESS").write_text("")
    df = read_csv_by_header(spark, str(tmp_path), SCHEMA)
    assert [f.name for f in df.schema] == SCHEMA.fieldNames()
    assert sorted((r.id, r.n, r.name, str(r.day)) for r in df.collect()) == [
        (1, 1.5, "x", "2020-01-01"), (2, 2.5, "y", "2020-01-02"), (3, 3.5, "w", "2020-01-03")]
    (tmp_path / "d.csv").write_text("id,n,day\n1,2,2020-01-01\n")
    with pytest.raises(HeaderMismatch, match="d.csv.*name"):
        read_csv_by_header(spark, str(tmp_path), SCHEMA)


# ---- audit -------------------------------------------------------------------------
def test_audit_counts_each_fault(spark):
    fact = spark.createDataFrame([(1, 1, 1), (2, 1, None), (3, 9, 2), (3, 9, 3), (None, 8, 3)], "id int, a int, b long")
    a = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    b = spark.createDataFrame([("1",), ("2",), ("3",), (None,)], "key string")
    got = {r.key: tuple(r)[1:] for r in key_audit(fact, ["id"], {"a": (a, "a"), "b": (b, "key")}).collect()}
    assert got == {"id": (5, 1, 0, 0, 1), "a": (5, 0, 2, 3, 1), "b": (5, 1, 0, 0, 0)}
    with pytest.raises(DuplicateKeys, match="a: 1"):
        assert_single_dimension_keys(key_audit(fact, ["id"], {"a": (a, "a")}), ["id"])
    assert_single_dimension_keys(key_audit(fact, ["id"], {"b": (b, "key")}), ["id"])


# ---- sketches ----------------------------------------------------------------------
def test_sketches_merge_over_seasons(spark):
    fact = spark.range(200_000).select((F.col("id") % 2).alias("e"), (F.col("id") % 7).alias("season"),
                                       (F.col("id") % 30_011).alias("race"))
    exact = {r.e: r.n for r in fact.groupBy("e").agg(F.count_distinct("race").alias("n")).collect()}
    sketches = distinct_sketches(fact, ["e"], "season", "race")
    assert sketches.count() == 14
    for r in merged_distinct(sketches, ["e"]).collect():
        assert abs(r.n_distinct - exact[r.e]) <= 0.02 * exact[r.e]


# ---- refreshes ---------------------------------------------------------------------
@pytest.fixture
def layer(spark, tmp_path):
    name = f"v_{uuid.uuid4().hex[:8]}"
    create_layer(spark, name, str(tmp_path / "db"))
    yield f"{name}.t", str(tmp_path / "t")
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_failed_refresh_leaves_the_old_rows(spark, layer):
    table, location = layer
    first = spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("p"))
    refresh_table(first, table, location, partition_by=["p"], contract=first.schema)
    boom = first.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        refresh_table(boom, table, location, partition_by=["p"], contract=first.schema)
    assert spark.table(table).count() == 10 and spark.table(table).columns == ["id", "p"]
    with pytest.raises(ContractViolation):
        refresh_table(first.drop("p"), table, location, contract=first.schema)

    def refuse(rows):
        assert rows.count() > 10

    with pytest.raises(AssertionError):
        refresh_table(first, table, location, contract=first.schema, check=refuse)
    assert spark.table(table).count() == 10 and len(versions(spark, location)) == 1


def test_reader_of_the_previous_version_goes_on(spark, layer):
    table, location = layer
    refresh_table(spark.range(5), table, location)
    reader = spark.table(table)
    refresh_table(spark.range(7), table, location)
    assert reader.count() == 5 and spark.table(table).count() == 7
    refresh_table(spark.range(9).limit(0), table, location)
    assert spark.table(table).count() == 0 and len(versions(spark, location)) == 2
    assert len([f for f in os.listdir(location) if f.startswith("v-")]) == 2


def test_refreshes_beside_each_other_are_complete(spark, layer):
    from concurrent.futures import ThreadPoolExecutor
    table, location = layer
    refresh_table(spark.range(1), table, location)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda n: refresh_table(spark.range(n, numPartitions=4), table, location, keep=5), (100, 200)))
    assert spark.table(table).count() in (100, 200)


# ---- clustered writes --------------------------------------------------------------
def test_clustered_files_prune(spark, tmp_path):
    from strata.sinks.clustered import row_groups, write_clustered
    hot = F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") % 1000)
    rows = spark.range(30_000).select(hot.cast("int").alias("k"), F.col("id").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1)] * 10, "k int, v long"))
    near, plain = str(tmp_path / "near"), str(tmp_path / "plain")
    write_clustered(rows, near, ["k", "v"], files=12)
    rows.repartition(12).write.parquet(plain)
    few, many = row_groups(spark, near, "k", 900, 910), row_groups(spark, plain, "k", 900, 910)
    assert few[0] <= 2 and many[0] == many[1] == 12
    # the hot value's rows are in several files
    assert row_groups(spark, near, "k", 50, 50)[0] >= 3
    a, b = (spark.read.parquet(p).where("k between 900 and 910") for p in (near, plain))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0
    files = {}
    for r in spark.read.parquet(near).selectExpr("input_file_name() f", "k").collect():
        files.setdefault(r.f, []).append(-1 if r.k is None else r.k)
    assert all(x == sorted(x) for x in files.values())
