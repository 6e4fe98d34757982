"""Dimension joins: left enrichment, inner lookup, anti join, key checks.

The physical strategy is left to Spark. With AQE on, a join side whose
*measured* shuffle output is small becomes a broadcast at run time, and a
larger one stays a sort-merge join (skewed partitions split by AQE's skew-join
handling). Dimensions that grow with the data are never hinted.

``broadcast_if_small`` is for sides whose size is bounded by the data model
(status codes, one row per season, one row per distinct win count) but whose
size the static planner cannot know. Without it, the big side would be shuffled
on a handful of keys before AQE could convert the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import store


BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES, *,
                       is_stored: bool = False) -> DataFrame:
    """Broadcast ``df`` only after measuring that it holds at most ``max_bytes``.

    The frame is stored once (``is_stored``: it only reads a stored table); one aggregate (a partial sum per task) counts its rows
    and the bytes of its texts, so the bound is on measured data, not on an estimate.
    Above the bound, or when the session has switched broadcasts off
    (``spark.sql.autoBroadcastJoinThreshold`` < 0), the stored frame is returned as it is
    and the join stays a shuffle join. For sides of few, flat columns.
    """
    df = df if is_stored else store(df, "side")
    fixed, texts = 0, F.lit(0)
    for field in df.schema.fields:
        fixed += 16
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts = texts + F.coalesce(F.octet_length(field.name), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(texts).alias("bytes")).first()
    off = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().startswith("-")
    small = row["n"] * fixed + (row["bytes"] or 0) <= max_bytes
    return F.broadcast(df) if small and not off else df


def fits_broadcast(df: DataFrame, rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has only fixed-width columns and its counted ``rows`` stay within the bound."""
    fixed = all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))
                for f in df.schema.fields)
    off = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().startswith("-")
    return fixed and not off and rows * 16 * len(df.columns) <= max_bytes


def _narrow(dim: DataFrame, keys: Sequence[str], columns: Sequence[str] | None) -> DataFrame:
    if columns is None:
        return dim
    return dim.select(*dict.fromkeys([*keys, *columns]))


def left_enrich(fact: DataFrame, dim: DataFrame, key: str | Sequence[str],
                columns: Sequence[str] | None = None) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)``: every fact row kept, unmatched -> nulls."""
    keys = [key] if isinstance(key, str) else list(key)
    return fact.join(_narrow(dim, keys, columns), keys, "left")


def left_enrich_on(fact: DataFrame, dim: DataFrame, left_key: str, right_key: str,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Expression-form left join on differently named keys.

    Both keys survive; callers that select the **right** key get null for an
    unmatched fact row (the modelled standings fact does exactly that).
    """
    narrowed = _narrow(dim, [right_key], columns)
    return fact.join(narrowed, fact[left_key] == narrowed[right_key], "left")


def inner_enrich(fact: DataFrame, dim: DataFrame, key: str | Sequence[str],
                 columns: Sequence[str] | None = None) -> DataFrame:
    """``fact JOIN dim USING (key)``: facts of unknown entities are dropped."""
    keys = [key] if isinstance(key, str) else list(key)
    return fact.join(_narrow(dim, keys, columns), keys, "inner")


def exclude_keys(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key never occurs in ``other`` (left anti join)."""
    return df.join(other.select(key), key, "left_anti")


def distinct_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(*keys).distinct()


def duplicate_keys(dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once (they would multiply facts in a join)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def assert_unique_keys(dim: DataFrame, key: str | Sequence[str], name: str = "dimension") -> None:
    """Opt-in guard (one aggregate job); raises on the first duplicated key."""
    dup = duplicate_keys(dim, key).limit(1).collect()
    if dup:
        raise ValueError(f"{name}: key {key!r} is not unique, e.g. {dup[0].asDict()}")
