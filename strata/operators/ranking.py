"""Rankings, top-k and sorted read-back.

``rank_values`` ranks like ``rank().over(Window[.partitionBy(g)].orderBy(v))``
without moving a whole group, or without a partition key the whole table, into
one task. ``rank_within`` keeps the plain window for inputs whose groups are many
and small, and for ``row_number``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.enrich import broadcast_if_small, fits_broadcast
from strata.session import store

_RANKERS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}

# Collapsed values in one slice (one window task) of ``rank_values``.
SLICE_ROWS = 500_000


def _order(column: str, descending: bool) -> Column:
    return F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_first()


def rank_within(df: DataFrame, partition_by: Sequence[str], order_by: str, output: str,
                method: str = "dense_rank", descending: bool = True) -> DataFrame:
    """Window rank per group (e.g. per season). Parallelism = number of groups."""
    w = Window.partitionBy(*partition_by).orderBy(_order(order_by, descending))
    return df.withColumn(output, _RANKERS[method]().over(w))


def rank_values(df: DataFrame, partition_by: Sequence[str], order_by: str, output: str,
                method: str = "rank", descending: bool = True,
                slice_rows: int = SLICE_ROWS, repeatable: bool = False) -> DataFrame:
    """Exact ``rank`` / ``dense_rank`` per group, with no task holding a whole group.

    One path at every size:

    1. the input is stored once, so that the values ranked and the values joined
       back are the same bits (a sum of doubles may differ between two runs). An input
       that gives the same values each time (``repeatable``: counts over stored tables)
       is read twice instead, and only its collapsed values are stored;
    2. rows collapse to one per (group, value) with their count (partial
       aggregation, so a hot value costs one row per task);
    3. the collapsed rows are range-partitioned by (group, value) at sampled
       quantiles into slices of about ``slice_rows``, and stored with their slice;
       any orderable type will do, and a hot group spans many slices;
    4. per (group, slice) totals and their running sums give each slice its offset
       (one row per group plus one per slice);
    5. values are ranked inside (group, slice), the offset is added, and the rank
       is joined back on (group, value), null-safely.

    Equals ``rank()`` / ``dense_rank()`` over
    ``Window.partitionBy(*partition_by).orderBy(order_by)``, with nulls last when
    descending and first when ascending.
    """
    if method not in ("rank", "dense_rank"):
        raise ValueError("rank_values supports 'rank' and 'dense_rank'")
    keys = list(partition_by)
    v, n, s = "__rank_value", "__rank_rows", "__rank_slice"
    df = df if repeatable else store(df, "rank-input")
    values = df.groupBy(*keys, F.col(order_by).alias(v)).agg(F.count(F.lit(1)).alias(n))
    values = store(values, "rank-collapsed") if repeatable else values
    # what is stored bounds the number of values (its count is in the file footers)
    held = (values if repeatable else df).count()
    slices = max(1, -(-held // slice_rows))
    if slices > 1:
        values = values.repartitionByRange(slices, *keys, _order(v, descending))
        values = store(values.withColumn(s, F.spark_partition_id()), "rank-values")
    else:
        values = values.withColumn(s, F.lit(0))
    weight = F.col(n) if method == "rank" else F.lit(1)
    unit = [*keys, s]
    inside = (Window.partitionBy(*unit).orderBy(_order(v, descending))
              .rowsBetween(Window.unboundedPreceding, -1))
    position = F.coalesce(F.sum(weight).over(inside), F.lit(0)) + 1
    if slices > 1:
        totals = values.groupBy(*unit).agg(F.sum(weight).alias("__weight"))
        before = (Window.partitionBy(*keys).orderBy(s)
                  .rowsBetween(Window.unboundedPreceding, -1))
        offsets = totals.select(*unit, F.coalesce(F.sum("__weight").over(before), F.lit(0))
                                .alias("__offset"))
        values = _join_on_keys(values, broadcast_if_small(offsets), unit)
        position = position + F.col("__offset")
    ranked = values.select(*keys, v, position.cast("int").alias(output))
    if repeatable and fits_broadcast(ranked, held):
        ranked = F.broadcast(ranked)            # the input then needs no shuffle
    return _join_on_keys(df, ranked, keys, value=(order_by, v)).drop(v)


def _join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  value: tuple[str, str] | None = None) -> DataFrame:
    """Inner join on same-named key columns, null-safe; keeps the left's keys."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    if value is not None:
        cond.append(left[value[0]].eqNullSafe(r[value[1]]))
    joined = left.join(r, cond, "inner")
    return joined.drop(*[f"__r_{k}" for k in keys])


def global_rank(df: DataFrame, order_by: str, output: str, method: str = "rank",
                descending: bool = True, slice_rows: int = SLICE_ROWS,
                repeatable: bool = False) -> DataFrame:
    """Table-wide ``rank`` / ``dense_rank``: ``rank_values`` with one group."""
    return rank_values(df, [], order_by, output, method, descending, slice_rows, repeatable)


def top_k(df: DataFrame, order_by: Sequence[Column | str], k: int) -> DataFrame:
    """``ORDER BY ... LIMIT k``: planned as TakeOrderedAndProject (per-task top-k,
    then a k x tasks merge), never a full sort. Callers pass a unique key last so
    ties at the cut are deterministic."""
    return df.orderBy(*order_by).limit(k)


def top_k_per_group(df: DataFrame, rank_column: str, k: int) -> DataFrame:
    """Rows whose (already computed) per-group rank is within the first ``k``."""
    return df.filter(F.col(rank_column) <= k)


def sorted_for_read(df: DataFrame, *order_by: Column | str) -> DataFrame:
    """Read-side ordering. Stored tables carry no order, so sinks never sort. Callers
    pass a unique key last."""
    return df.orderBy(*order_by)
