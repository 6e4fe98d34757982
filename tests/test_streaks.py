"""Sliced row numbers and runs against the plain windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import streaks
from strata.operators.ranking import global_rank
from strata.operators.streaks import _offsets, consecutive_streaks, with_row_number
from strata.session import store


def frame(spark, rows=900):
    """One entity has a third of the rows; another has none but null values."""
    import random
    rng = random.Random(2)
    data = set()
    while len(data) < rows // 3:
        data.add((0, "hot", rng.randint(0, rows // 2)))
    data = list(data) + [(e, f"e{e}", s) for e in range(1, 40) for s in rng.sample(range(60), 15)]
    data += [(41, "n", None), (41, "n", None), (None, None, 1), (None, None, 2), (42, "a", 1), (42, "b", 2), (42, "b", 3)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "id int, name string, seq int")


@pytest.mark.parametrize("slice_rows", [7, 100, 10_000])
def test_row_number_equals_plain_window(spark, slice_rows):
    df = frame(spark).distinct()
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("seq")))
    ours = with_row_number(df, ["id"], "seq", "n", slice_rows=slice_rows)
    assert ours.columns == plain.columns and ours.schema["n"].dataType == plain.schema["n"].dataType
    key = lambda r: str(tuple(r))
    assert sorted(ours.collect(), key=key) == sorted(plain.collect(), key=key)


def test_equal_values_share_a_slice_or_not(spark):
    """Repeated values are numbered once each, also over slice borders."""
    df = spark.createDataFrame([(1, 5)] * 50 + [(1, 4)] * 3, "id int, seq int")
    got = with_row_number(df, ["id"], "seq", "n", slice_rows=6).collect()
    assert sorted(r.n for r in got) == list(range(1, 54))
    assert {r.n for r in got if r.seq == 4} == {1, 2, 3}


@pytest.mark.parametrize("slice_rows", [5, 64, 10_000])
def test_streaks_equal_plain_form(spark, slice_rows):
    df = frame(spark)
    w = Window.partitionBy("id").orderBy("seq")
    plain = (df.withColumn("run", F.col("seq") - F.row_number().over(w)).groupBy("id", "name", "run")
             .agg(F.min("seq").alias("streak_start_year"), F.max("seq").alias("streak_end_year"),
                  F.count("*").cast("int").alias("streak_length")).where("streak_length >= 2").drop("run"))
    ours = consecutive_streaks(df, ["id", "name"], "seq", slice_rows=slice_rows)
    key = lambda r: str(tuple(r))
    assert sorted(ours.collect(), key=key) == sorted(plain.collect(), key=key)
    assert ours.where("streak_length > 5").count() > 0


def test_no_task_holds_the_hot_entity(spark):
    """(entity, slice) groups stay within about twice the slice; offsets are one a slice."""
    rows = frame(spark, 3000).repartitionByRange(12, "id", "seq").withColumn("__slice", F.spark_partition_id())
    assert _offsets(rows, ["id"], "__slice").count() <= 12
    assert rows.groupBy("id", "__slice").count().agg(F.max("count")).first()[0] <= 600


def test_short_slices_do_not_make_a_task_each(spark, monkeypatch):
    held = []
    monkeypatch.setattr(streaks, "SLICES", 8)
    monkeypatch.setattr(streaks, "store", lambda df, name: held.append(store(df, name)) or held[-1])
    df = spark.createDataFrame([(i % 3 and 1, i // 2) for i in range(300)], "id int, seq int")
    got = with_row_number(df, ["id"], "seq", "n", slice_rows=1).collect()
    assert held[-1].agg(F.count_distinct("__slice")).first()[0] <= 8
    assert sorted((r.id, r.n) for r in got) == [(0, i) for i in range(1, 101)] + [(1, i) for i in range(1, 201)]
    assert streaks._slices(10 ** 10, 1000) == 10 ** 10 // streaks.SLICE_ROWS


def test_empty_input(spark):
    assert consecutive_streaks(frame(spark).limit(0), ["id", "name"], "seq").count() == 0


def test_repeatable_input_is_ranked_alike(spark):
    df = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(100)], "id int, v int")
    for method in ("rank", "dense_rank"):
        a = global_rank(df, "v", "r", method, slice_rows=3)
        b = global_rank(df, "v", "r", method, repeatable=True, slice_rows=3)
        assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)
