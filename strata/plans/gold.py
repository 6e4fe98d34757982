"""Gold layer: the six reporting tables, as pure functions of silver frames.

Rankings and last-round rows use the forms that keep no whole group in one task
(see ``strata.operators.ranking`` / ``snapshots``). None of the builders sorts:
stored tables carry no order, readers sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.enrich import exclude_keys, inner_enrich
from strata.operators.ranking import global_rank, rank_values
from strata.operators.rollups import career_aggregates, season_totals
from strata.operators.snapshots import last_round_leaders
from strata.operators.streaks import consecutive_streaks


def constructor_career(fact: DataFrame, constructors: DataFrame) -> DataFrame:
    return (inner_enrich(fact, constructors, "constructor_id",
                         ["constructor_name", "nationality"])
            .groupBy("constructor_id", "constructor_name", "nationality")
            .agg(*career_aggregates()))


def driver_career(fact: DataFrame, drivers: DataFrame, *,
                  approximate_distinct: bool = False) -> DataFrame:
    return (inner_enrich(fact, drivers, "driver_id", ["full_name", "nationality"])
            .groupBy("driver_id", "full_name", "nationality")
            .agg(*career_aggregates(distinct_of="race_id",
                                    approximate_distinct=approximate_distinct)))


def season_totals_by_constructor(fact: DataFrame, constructors: DataFrame) -> DataFrame:
    return (inner_enrich(fact, constructors, "constructor_id", ["constructor_name"])
            .groupBy("race_year", "constructor_id", "constructor_name")
            .agg(*season_totals()))


def constructor_standings(fact: DataFrame, constructors: DataFrame) -> DataFrame:
    """Season totals ranked per season with dense_rank (ties share a rank)."""
    totals = season_totals_by_constructor(fact, constructors)
    ranked = rank_values(totals, ["race_year"], "total_points", "season_rank", "dense_rank")
    return ranked.select("race_year", "constructor_id", "constructor_name", "total_points",
                         "wins", "podiums", "season_rank")


def constructor_dominance(standings: DataFrame, min_length: int = 2) -> DataFrame:
    """Runs of consecutive seasons at season_rank 1."""
    leaders = (standings.filter(F.col("season_rank") == 1)
               .select("constructor_id", "constructor_name", "race_year"))
    return consecutive_streaks(leaders, ["constructor_id", "constructor_name"], "race_year",
                               window_partition=["constructor_id"], min_length=min_length)


def season_champions(standings: DataFrame, drivers: DataFrame) -> DataFrame:
    leaders = last_round_leaders(standings, "race_year", "round", "position")
    return (inner_enrich(leaders, drivers, "driver_id", ["full_name"])
            .select("race_year", "driver_id", "full_name",
                    F.col("points").alias("champion_points")))


def drivers_without_title(career: DataFrame, champions: DataFrame) -> DataFrame:
    """Drivers with at least one win who never appear among the champions,
    ranked table-wide by wins (rank: gaps after ties)."""
    candidates = exclude_keys(career, champions, "driver_id").filter(F.col("total_wins") > 0)
    # wins are counts over stored tables: the same each time they are read
    ranked = global_rank(candidates, "total_wins", "rank_by_wins", "rank", repeatable=True)
    return ranked.select("driver_id", "full_name", "total_wins", "total_points",
                         "rank_by_wins")
