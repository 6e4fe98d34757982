"""Key audit: orphans, nulls and duplicates of all keys of a fact in one pass over it.

Every fact row gives one tagged value per key (its own and the foreign ones), every dimension
row one tagged value. One grouping by (key, value), which combines map-side, then
tells how often a value stands on either side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    pass


def _tagged(df: DataFrame, columns: Mapping[str, str], side: str) -> DataFrame:
    """(key, value, fact_rows, dim_rows): one row per row and key (name of the key -> column)."""
    values = F.explode(F.array(*[F.struct(F.lit(name).alias("key"), F.col(c).cast("string").alias("value"))
                                 for name, c in columns.items()])).alias("k")
    return df.select(values).select("k.*", F.lit(int(side == "fact")).alias("f"), F.lit(int(side == "dim")).alias("d"))


def key_audit(fact: DataFrame, own: Sequence[str], foreign: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row a key of ``fact``: key, rows, null_rows, orphan_keys and orphan_rows (values that the
    dimension lacks), duplicate_keys (values that occur more than once where they
    must not: in the fact for its own keys, in the dimension for foreign ones).

    ``foreign`` maps a column of the fact to (dimension, its key column)."""
    tagged = _tagged(fact, {c: c for c in [*own, *foreign]}, "fact")
    for column, (dim, key) in foreign.items():
        tagged = tagged.unionByName(_tagged(dim, {column: key}, "dim"))
    counted = tagged.groupBy("key", "value").agg(F.sum("f").alias("f"), F.sum("d").alias("d"))
    is_own = F.col("key").isin(list(own)) if own else F.lit(False)
    orphan = ~is_own & F.col("value").isNotNull() & (F.col("f") > 0) & (F.col("d") == 0)
    twice = F.col("value").isNotNull() & F.when(is_own, F.col("f") > 1).otherwise(F.col("d") > 1)
    return counted.groupBy("key").agg(
        F.sum("f").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("f"))), F.lit(0)).alias("null_rows"),
        F.count_if(orphan).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("f"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(twice).alias("duplicate_keys"))


def assert_single_dimension_keys(audit: DataFrame, own: Sequence[str]) -> None:
    """Raises if a dimension's key repeats: it would multiply facts in a join."""
    bad = [r.asDict() for r in audit.where(F.col("duplicate_keys") > 0).collect() if r["key"] not in own]
    if bad:
        raise DuplicateKeys("; ".join(f"{r['key']}: {r['duplicate_keys']} repeated keys" for r in bad))
