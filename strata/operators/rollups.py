"""Grouped roll-ups: sums, conditional counts, min/max, exact distinct counts.

All of them are algebraic, so Spark runs a partial (map-side) aggregate before
the shuffle; only one row per group and task crosses the network. The exact
distinct count expands into Spark's two-phase plan (group by key + value, then
by key), which also partial-aggregates and so survives a hot key.
"""

from __future__ import annotations

import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import conditional_count


# Bits in one part of an exact sum: sums of 2**39 rows fit 64 bits.
PART_BITS = 24
# Exponents of the bits that an exact sum covers unless others are measured.
LOWEST, HIGHEST = -100, 68


def _two_to(e: int) -> list[float]:
    """2**e as factors within the range of doubles."""
    return [2.0 ** e] if abs(e) <= 1000 else [2.0 ** (e // 2), 2.0 ** (e - e // 2)]


@F.arrow_udf(T.DoubleType())
def _rounded(parts: pa.Array, low: pa.Array, rest: pa.Array) -> pa.Array:
    out = []
    for digits, exponent, beyond in zip(parts.to_pylist(), low.to_pylist(), rest.to_pylist()):
        if digits is None or digits[0] is None:
            out.append(None)
        elif beyond is not None and not math.isfinite(beyond):
            out.append(beyond)
        else:
            total = 0
            for digit in digits:
                total = (total << PART_BITS) + digit
            exact = Fraction(total) * Fraction(2) ** exponent + Fraction(beyond or 0.0)
            try:
                out.append(float(exact))                 # to the nearest double, ties to even
            except OverflowError:
                out.append(math.inf if exact > 0 else -math.inf)
    return pa.array(out, pa.float64())


def exact_sum(column: str, lowest: int = LOWEST, highest: int = HIGHEST) -> Column:
    """Sum of doubles, correctly rounded once: what ``math.fsum`` gives, whatever the order in
    which partial sums meet.

    A value is cut into parts of ``PART_BITS`` bits, between 2**lowest and 2**highest; each
    part is an integer and summed as such, so the sums combine map-side and no
    rounding happens before the last step (once per group, over about eight numbers). Values that are
    not a multiple of 2**lowest (only values below 2**(lowest + 53) can be none) or reach
    2**highest are summed as doubles beside, as are infinities and NaN; ``exact_range`` measures
    bounds that leave none. Nulls are left out, a group of nulls is null."""
    x = F.col(column).cast("double")
    units = list(range(highest - PART_BITS, lowest - PART_BITS, -PART_BITS))
    low = units[-1]
    beyond = F.isnan(x) | (F.abs(x) >= _literal(highest)) | (x % _literal(low) != 0)
    value = F.when(beyond, F.lit(0.0)).otherwise(x)
    parts = []
    for unit in units:
        part = value % _literal(unit + PART_BITS)
        for factor in _two_to(-unit):
            part = part * F.lit(factor)
        parts.append(F.sum(part.cast("bigint")))
    return _rounded(F.array(*parts), F.lit(low), F.sum(F.when(beyond, x)))


def _literal(e: int) -> Column:
    """2**e, at least the smallest double and at most infinity."""
    return F.lit(2.0 ** max(e, -1074) if e < 1024 else math.inf)


def exact_range(df: DataFrame, column: str) -> tuple[int, int]:
    """(lowest, highest) for ``exact_sum``, from one aggregate over the column."""
    size = F.floor(F.log2(F.abs(F.col(column).cast("double"))))
    finite = (F.col(column) != 0) & ~F.isnan(column) & (F.abs(column) < math.inf)
    row = df.where(finite).agg(F.min(size).alias("lo"), F.max(size).alias("hi")).first()
    if row.lo is None:
        return LOWEST, HIGHEST
    # the logarithm may be off by one; below 2**-1022 doubles have fewer bits
    lowest = max(int(row.lo) - 54, -1074)
    parts = -(-(int(row.hi) + 2 - lowest) // PART_BITS)
    return lowest, lowest + parts * PART_BITS


def career_aggregates(points: str = "points", win: str = "is_win", podium: str = "is_podium",
                      season: str = "race_year", distinct_of: str | None = None,
                      approximate_distinct: bool = False,
                      rsd: float = 0.01) -> list[Column]:
    aggs = [
        exact_sum(points).alias("total_points"),
        conditional_count(win).alias("total_wins"),
        conditional_count(podium).alias("total_podiums"),
    ]
    if distinct_of is not None:
        distinct = (F.approx_count_distinct(distinct_of, rsd) if approximate_distinct
                    else F.count_distinct(distinct_of))
        aggs.append(distinct.cast("int").alias("races_disputed"))
    aggs += [F.min(season).alias("first_season"), F.max(season).alias("last_season")]
    return aggs


def season_totals(points: str = "points", win: str = "is_win",
                  podium: str = "is_podium") -> list[Column]:
    return [exact_sum(points).alias("total_points"),
            conditional_count(win).alias("wins"),
            conditional_count(podium).alias("podiums")]
