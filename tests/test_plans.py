"""Physical-plan properties: pushdown, pruning, no single-partition detail window."""

import os
import re

import pytest
from pyspark.sql import functions as F

from strata.operators.enrich import broadcast_if_small
from strata.operators.ranking import global_rank
from strata.plans.queries import QUERIES
from strata.sources.standins import StandInTables

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    tables = StandInTables.of(spark, SF_DIR)
    plan = plan_of(tables.results().select("driver_id", "points"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    plan = plan_of(tables.races().select("race_id"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in plan
    pending = tables.table("orders").filter("o_orderstatus = 'P'").select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,P)]" in plan_of(pending)


def test_silver_fact_reads_only_needed_bronze_columns(spark):
    fact = StandInTables.of(spark, SF_DIR).silver["fact_results"].select("driver_id", "points")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan_of(fact))
    assert any("points:double" in s for s in schemas)
    for unused in ("position_text", "milliseconds", "constructor_id", "number_results"):
        assert not any(unused in s for s in schemas), schemas


def test_season_filter_reaches_the_scan(spark):
    standings = StandInTables.of(spark, SF_DIR).stored("fact_driver_standings")
    plan = plan_of(standings.filter("race_year = 24000"))
    assert "PushedFilters: [IsNotNull(race_year), EqualTo(race_year,24000)]" in plan


@pytest.mark.parametrize("name", ["season_champions", "season_standings_dense_rank"])
def test_no_rows_meet_in_one_partition(spark, name):
    assert "SinglePartition" not in plan_of(QUERIES[name](spark, SF_DIR))


def test_table_wide_rank_meets_in_slices(spark):
    """Without keys the rows of a slice meet, and nothing larger."""
    df = spark.range(0, 3000).selectExpr("id", "id % 700 AS v")
    plan = plan_of(global_rank(df, "v", "r", slice_rows=500))
    assert "SinglePartition" not in plan and "__rank_slice" in plan


def test_standings_scan_the_facts_once(spark):
    """The ranking reads its stored input, not the facts again."""
    plan = plan_of(QUERIES["season_standings_dense_rank"](spark, SF_DIR))
    assert "silver-fact_results" not in plan


def test_checked_broadcast(spark):
    df = spark.range(0, 1000).selectExpr("id", "cast(id AS string) AS t")
    side = spark.range(0, 50).selectExpr("id", "cast(id AS string) AS t2").groupBy("id").agg(
        F.max("t2").alias("t2"))
    plan = plan_of(df.join(broadcast_if_small(side), "id"))
    assert "BroadcastHashJoin" in plan and "SinglePartition" not in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" not in plan_of(df.join(broadcast_if_small(side), "id"))
        assert "BroadcastHashJoin" not in plan_of(df.join(broadcast_if_small(side, max_bytes=100), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_topk_is_take_ordered(spark):
    plan = plan_of(QUERIES["topk_career"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan
