"""Dashboard data views over the gold tables.

Top-k views break ties by the entity key, so the cut is deterministic;
"top k" on a rank column keeps every tied row instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.ranking import top_k, top_k_per_group


def top10_drivers(driver_career: DataFrame, k: int = 10) -> DataFrame:
    return top_k(driver_career.select("driver_id", "full_name", "nationality", "total_wins"),
                 [F.col("total_wins").desc(), F.col("driver_id")], k)


def top10_constructors(constructor_career: DataFrame, k: int = 10) -> DataFrame:
    view = constructor_career.select("constructor_id", "constructor_name", "nationality",
                                     "total_wins")
    return top_k(view, [F.col("total_wins").desc(), F.col("constructor_id")], k)


def champion_points(season_champions: DataFrame) -> DataFrame:
    return season_champions.select("race_year", "full_name", "champion_points")


def uncrowned(drivers_without_title: DataFrame, k: int = 10) -> DataFrame:
    """Most wins without a title: every driver ranked within the first k."""
    return top_k_per_group(drivers_without_title, "rank_by_wins", k)


def streaks(constructor_dominance: DataFrame) -> DataFrame:
    return constructor_dominance.select("constructor_name", "streak_start_year",
                                        "streak_end_year", "streak_length")


def season_range(df: DataFrame, first: int, last: int, season: str = "race_year") -> DataFrame:
    """The dashboard's from / to season filter (pushed into scans and partitions)."""
    return df.filter(F.col(season).between(first, last))


def top_n_of_season(standings: DataFrame, season: int, n: int = 5) -> DataFrame:
    """Top n of one selected season; ties on points share a rank and are all kept."""
    return top_k_per_group(standings.filter(F.col("race_year") == season), "season_rank", n)


def top_n_of_latest_season(standings: DataFrame, n: int = 5) -> DataFrame:
    """The season selector set to the latest season present (an equi-join with
    the one-row max, so the season is read from the data, not from the driver)."""
    latest = standings.agg(F.max("race_year").alias("__latest"))
    picked = standings.join(latest, standings["race_year"] == latest["__latest"], "inner")
    return top_k_per_group(picked.drop("__latest"), "season_rank", n)
