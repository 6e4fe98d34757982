"""Rows of the last round present in each season (e.g. final standings).

The plain form ``max(round) OVER (PARTITION BY season)`` sorts every detail
row by season, and one big season becomes one big task. The scalable form
aggregates ``max(round)`` per season (partial aggregation: one row per season
and task crosses the shuffle) and joins that small result back. The season
match is null-safe, because the window form also keeps a null-season partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.enrich import broadcast_if_small


def last_round_rows(df: DataFrame, season: str, round_col: str) -> DataFrame:
    last = df.groupBy(F.col(season).alias("__season")).agg(
        F.max(round_col).alias("__last_round"))
    last = broadcast_if_small(last)      # one row per season
    cond = df[season].eqNullSafe(last["__season"]) & (df[round_col] == last["__last_round"])
    return df.join(last, cond, "inner").drop("__season", "__last_round")


def last_round_leaders(df: DataFrame, season: str, round_col: str, position: str,
                       leader: int = 1) -> DataFrame:
    """Position-``leader`` rows at the last round present; ties give several
    leaders, a last round without that position gives none."""
    return last_round_rows(df, season, round_col).filter(F.col(position) == leader)
