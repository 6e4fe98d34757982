"""Row numbers and gaps-and-islands runs, with no task holding a whole entity.

``row_number()`` over an entity's window puts the entity into one task. Here the rows are
range-partitioned by (entity, value) into slices of about ``SLICE_ROWS``, numbered inside
(entity, slice), and moved on by the number of the entity's rows in the slices before. A
slice is a task, so slices beyond ``SLICES`` are longer instead (up to ``SLICE_ROWS``): what the
driver hears of tasks and of sampled borders does not grow with small slices. As
slices are ranges, at most one entity crosses the border of two slices: the offsets that are
not zero are at most one a slice, which bounds their broadcast.

``seq - row_number()`` is constant inside a run of consecutive values. A slice gives one
partial run (first, last, length) per run it holds, and partial runs of one id merge by
minimum, maximum and sum, so a run over many slices is stitched together by a
grouping that combines map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import store

# Rows of one entity in one window task.
SLICE_ROWS = 500_000
# Slices up to which shorter ones are kept as short as asked.
SLICES = 256


def with_row_number(df: DataFrame, partition_by: Sequence[str], order_by: str,
                    output: str = "row_number", *, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``row_number()`` over ``Window.partitionBy(*partition_by).orderBy(order_by)``: nulls come
    first, equal values are numbered in the order of the stored rows.

    The input is stored once, so that its rows are the same in every later step."""
    keys, at, part = list(partition_by), "__row", "__slice"
    rows = store(df.withColumn(at, F.monotonically_increasing_id()), "numbered")
    # at least the rows of any entity (the count is in the file footers)
    slices = _slices(rows.count(), slice_rows)
    offsets = None
    if slices > 1:
        ranged = rows.repartitionByRange(slices, *keys, order_by, at)
        rows = store(ranged.withColumn(part, F.spark_partition_id()), "numbered-slices")
        offsets = _offsets(rows, keys, part)
    else:
        rows = rows.withColumn(part, F.lit(0))
    inside = Window.partitionBy(*keys, part).orderBy(order_by, at)
    numbered = rows.withColumn(output, F.row_number().over(inside))
    if offsets is not None:
        # a slice's continued entity is the only one with an offset
        same = [numbered[k].eqNullSafe(offsets[f"__of_{k}"]) for k in keys]
        numbered = numbered.join(F.broadcast(offsets), [numbered[part] == offsets["__of_slice"], *same], "left")
        moved = F.col(output) + F.coalesce(F.col("__offset"), F.lit(0))
        numbered = numbered.withColumn(output, moved.cast("int"))
    return numbered.select(*df.columns, output)


def _slices(count: int, slice_rows: int) -> int:
    wanted = max(1, -(-count // slice_rows))
    return min(wanted, max(SLICES, -(-count // SLICE_ROWS)))


def _offsets(rows: DataFrame, keys: Sequence[str], part: str) -> DataFrame:
    """Rows of an entity in earlier slices, where there are any (at most one row a slice)."""
    held = rows.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return held.select(*[F.col(k).alias(f"__of_{k}") for k in keys], F.col(part).alias("__of_slice"),
                       F.sum("__rows").over(before).alias("__offset")).where("__offset > 0")


def consecutive_streaks(df: DataFrame, entity_columns: Sequence[str], sequence: str, *,
                        window_partition: Sequence[str] | None = None, min_length: int = 2,
                        start: str = "streak_start_year", end: str = "streak_end_year",
                        length: str = "streak_length", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Runs of consecutive values of at least ``min_length`` rows. Rows are numbered by
    ``window_partition`` (the first entity column by default) and grouped by all entity
    columns; null values form one group without a start and an end."""
    number, run = "__number", "__run_id"
    partition = list(window_partition or entity_columns[:1])
    rows = df.select(*dict.fromkeys([*partition, *entity_columns, sequence]))
    tagged = with_row_number(rows, partition, sequence, number, slice_rows=slice_rows)
    return (tagged.withColumn(run, F.col(sequence) - F.col(number))
            .groupBy(*entity_columns, run)
            .agg(F.min(sequence).alias(start), F.max(sequence).alias(end),
                 F.count(F.lit(1)).cast("int").alias(length))
            .filter(F.col(length) >= min_length)
            .drop(run))
