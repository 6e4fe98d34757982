"""Left joins whose fact side has hot foreign keys.

A hash join sends all rows of a key to one task, and AQE can split that task only after the
rows were shuffled there. Here a sketch finds the heavy hitters first. Facts of a heavy key
or of no key stay where they are: the few dimension rows of the heavy keys come
to them by broadcast, and a null key matches nothing. All other facts are shuffled as usual.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.enrich import _narrow, broadcast_if_small

MOST_HEAVY = 1000           # keys joined by broadcast
TRACKED = 16_384            # items of the sketch: counts are off by at most about rows / TRACKED


def heavy_keys(fact: DataFrame, key: str, share: float | None = None) -> list:
    """Keys that hold at least ``share`` of the rows (default: half of an even shuffle
    partition's), by a mergeable sketch of bounded size. At most ``MOST_HEAVY``."""
    if share is None:
        share = 0.5 / int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(share, 1 / MOST_HEAVY)
    row = fact.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {MOST_HEAVY}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in row["top"] or [] if r["count"] >= share * row["n"]]


def left_enrich_skewed(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str] | None = None, *,
                       share: float | None = None) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)``, every fact row kept. The fact is scanned once for the
    sketch (the key alone) and once for each of the two ways, so it should be a stored table."""
    dim = _narrow(dim, [key], columns)
    hot = heavy_keys(fact, key, share)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    stay = fact.where(F.col(key).isNull() | is_hot)
    move = fact.where(F.col(key).isNotNull() & ~is_hot)
    # a heavy key has one row in a dimension; if it has many, they are measured
    near = broadcast_if_small(dim.where(is_hot)) if hot else dim.limit(0)
    return stay.join(near, [key], "left").unionByName(move.join(dim.where(~is_hot), [key], "left"))
