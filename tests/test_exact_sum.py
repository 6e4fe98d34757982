"""Sums of doubles against math.fsum, bit for bit, under any order and partitioning."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.rollups import exact_range, exact_sum

VALUES = {
    "cents": lambda r: round(r.uniform(-1e5, 1e5), 2),
    "wide": lambda r: r.choice([-1, 1]) * r.uniform(1, 10) * 10 ** r.choice([-9, -3, 0, 6, 14]),
    "cancelling": lambda r: r.choice([1e15, -1e15, 1e-9, 0.1, -0.1]),
    "integers": lambda r: float(r.randint(-50, 50)),
}


def sums(df, *bounds):
    return {r.g: r.s for r in df.groupBy("g").agg(exact_sum("x", *bounds).alias("s")).collect()}


def bits(x):
    return None if x is None else x.hex()


@pytest.mark.parametrize("kind", list(VALUES))
def test_equals_fsum(spark, kind):
    rng = random.Random(kind)
    data = [(i % 5, VALUES[kind](rng)) for i in range(4000)]
    want = {g: math.fsum(x for h, x in data if h == g) for g in range(5)}
    df = spark.createDataFrame(data, "g int, x double")
    for parts in (1, 7):
        got = sums(df.orderBy(F.rand(parts)).repartition(parts))
        assert {g: bits(x) for g, x in got.items()} == {g: bits(x) for g, x in want.items()}


def test_measured_range_covers_all_doubles(spark):
    rng = random.Random(1)
    data = [(i % 4, rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.choice([-1060, -400, 0, 300, 1000])))
            for i in range(400)] + [(5, 5e-324), (5, 5e-324), (5, -1e300), (5, 1e300)]
    df = spark.createDataFrame(data, "g int, x double")
    got = sums(df, *exact_range(df, "x"))
    assert got == {g: math.fsum(x for h, x in data if h == g) for g in {h for h, _ in data}}


def test_nulls_infinities_and_values_beyond_the_range(spark):
    inf, nan = math.inf, math.nan
    data = [(1, None), (2, 1.5), (2, None), (3, inf), (3, 1.0), (4, inf), (4, -inf), (5, nan), (6, 1e300), (6, 1e-300),
            (6, 2.0), (7, 0.0), (7, -0.0)]
    got = sums(spark.createDataFrame(data, "g int, x double"))
    assert got[1] is None and got[2] == 1.5 and got[3] == inf and math.isnan(got[4]) and math.isnan(got[5])
    assert got[6] == 1e300 and got[7] == 0.0


def test_small_and_large_values_count(spark):
    got = sums(spark.createDataFrame([(1, 2e14), (1, 0.00004), (2, 0.1), (2, 0.2)], "g int, x double"))
    assert got == {1: 2e14 + 0.00004, 2: 0.1 + 0.2}
