"""Golden test: the whole 20-table refresh on the synthetic CSV inputs."""

import pytest
from pyspark.sql import functions as F

from fixtures import GOLD, write_fixtures
from strata.plans import schemas
from strata.plans.pipeline import PipelineConfig, reset_layers, run_pipeline
from strata.sources.csv import HeaderMismatch
from strata.sources.tables import read_table


def _rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()),
                  key=lambda r: tuple((x is None, x) for x in r))


@pytest.fixture(scope="module")
def pipeline(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    config = PipelineConfig(env=" DEV ", catalog_base="golden",
                            source_root=write_fixtures(str(base / "raw")),
                            warehouse_root=str(base / "warehouse"))
    rejects = run_pipeline(spark, config)
    yield config, rejects
    reset_layers(spark, config)


@pytest.mark.parametrize("table", sorted(GOLD))
def test_gold_tables(spark, pipeline, table):
    config, _ = pipeline
    df = read_table(spark, config.table("gold", table))
    columns = [n for n, _ in schemas.GOLD_COLUMNS[table]]
    expected = sorted(GOLD[table], key=lambda r: tuple((x is None, x) for x in r))
    assert _rows(df, columns) == expected


def test_all_twenty_tables_exist(spark, pipeline):
    config, _ = pipeline
    counts = {}
    for layer, names in (("bronze", ["circuits", "constructors", "drivers", "races", "results",
                                     "driver_standings", "status"]),
                         ("silver", list(schemas.SILVER_COLUMNS)),
                         ("gold", list(schemas.GOLD_COLUMNS))):
        for name in names:
            counts[(layer, name)] = read_table(spark, config.table(layer, name)).count()
    assert len(counts) == 20
    assert counts[("bronze", "results")] == 18
    assert counts[("silver", "fact_results")] == 18          # left joins keep every fact


def test_reject_counts(pipeline):
    _, rejects = pipeline
    assert rejects["circuits"] == {"circuit_id": 1}          # key "x"
    assert all(v == 0 for k, nulls in rejects.items() if k != "circuits" for v in nulls.values())
    assert set(rejects["results"]) == {"result_id", "race_id", "driver_id", "constructor_id", "status_id"}


def test_rejected_rows_are_quarantined(spark, pipeline):
    config, _ = pipeline
    rejected = read_table(spark, config.table("bronze", "circuits_rejected"))
    assert [r.circuit_ref for r in rejected.collect()] == ["bogus"]
    dim = read_table(spark, config.table("silver", "dim_circuits"))
    assert dim.filter("circuit_id IS NULL").count() == 0


def test_silver_text_holds_no_markers(spark, pipeline):
    config, _ = pipeline
    dim = read_table(spark, config.table("silver", "dim_drivers"))
    assert dim.filter("driver_id = 8").first().code is None
    for table in schemas.SILVER_COLUMNS:
        df = read_table(spark, config.table("silver", table))
        for field in df.schema.fields:
            if field.dataType.simpleString() == "string":
                assert df.filter(F.col(field.name) == "\\N").count() == 0


def test_wide_keys_reach_gold(spark, tmp_path):
    from pyspark.sql import types as T
    root = write_fixtures(str(tmp_path / "raw"), add_to_keys=3_000_000_000)
    config = PipelineConfig(catalog_base="wide", source_root=root,
                            warehouse_root=str(tmp_path / "wh"), id_type=T.LongType())
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        run_pipeline(spark, config)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    champions = read_table(spark, config.table("gold", "season_champions"))
    assert sorted(r.driver_id for r in champions.collect()) == [
        3_000_000_000 + d for d in sorted(r[1] for r in GOLD["season_champions"])]
    reset_layers(spark, config)


def test_bronze_keeps_raw_text_and_parses_edges(spark, pipeline):
    config, _ = pipeline
    circuits = read_table(spark, config.table("bronze", "circuits"))
    rows = {r.circuit_id: r for r in circuits.collect()}
    assert rows[1].altitude == 10
    assert rows[2].altitude is None                          # text NULL -> null, row kept
    assert rows[2].location == "São Pedro"
    assert rows[None].circuit_ref == "bogus"                 # bad key -> null key, row kept
    results = read_table(spark, config.table("bronze", "results"))
    r = results.filter("result_id = 1003").first()
    assert r.position == "\\N" and r.milliseconds == "\\N"   # markers stay literal in bronze
    assert "ingestion_date" in results.columns
    assert results.filter(F.col("ingestion_date").isNull()).count() == 0


def test_fact_results_flags(spark, pipeline):
    config, _ = pipeline
    fact = read_table(spark, config.table("silver", "fact_results"))
    by_id = {r.result_id: r for r in fact.collect()}
    assert by_id[1001].finished is True                      # Finished
    assert by_id[1002].finished is True                      # +1 Lap
    assert by_id[1004].finished is True                      # +12 Laps
    assert by_id[1005].finished is False                     # Lapped
    assert by_id[1003].finished is False                     # Accident
    assert by_id[2003].finished is False                     # unknown status
    assert by_id[2003].is_win is None and by_id[2003].is_podium is None
    assert by_id[4003].race_year is None and by_id[4003].circuit_id is None
    assert by_id[1003].is_podium is True and by_id[1003].is_win is False


def test_fact_driver_standings_loses_unknown_race(spark, pipeline):
    config, _ = pipeline
    fact = read_table(spark, config.table("silver", "fact_driver_standings"))
    row = fact.filter("driver_standings_id = 9").first()
    assert row.race_id is None and row.race_year is None and row.round is None


def test_dim_drivers_full_name_skips_null(spark, pipeline):
    config, _ = pipeline
    dim = read_table(spark, config.table("silver", "dim_drivers"))
    assert dim.filter("driver_id = 3").first().full_name == "Mansell"


def test_partitioned_tables_prune(spark, pipeline):
    config, _ = pipeline
    df = read_table(spark, config.table("silver", "fact_results")).filter("race_year = 2003")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "race_year" in plan
    assert df.count() == 3


def test_rerun_is_idempotent(spark, pipeline):
    config, _ = pipeline
    run_pipeline(spark, config)
    for table, expected in GOLD.items():
        df = read_table(spark, config.table("gold", table))
        assert _rows(df, [n for n, _ in schemas.GOLD_COLUMNS[table]]) == sorted(
            expected, key=lambda r: tuple((x is None, x) for x in r))


def test_swapped_header_fails_loudly(spark, tmp_path):
    config = PipelineConfig(env="dev", catalog_base="swapped",
                            source_root=write_fixtures(str(tmp_path / "raw"),
                                                       swap_header_of="status"),
                            warehouse_root=str(tmp_path / "wh"))
    from strata.plans.pipeline import bronze_frame
    with pytest.raises(HeaderMismatch):
        bronze_frame(spark, config, "status")


def test_config_validation():
    with pytest.raises(ValueError):
        PipelineConfig(env="qa")
    assert PipelineConfig(env=" Prod ").database("gold") == "strata_prod_gold"


def test_readbacks(spark, pipeline):
    from strata.plans.pipeline import READBACKS, readback
    config, _ = pipeline
    leaders = readback(spark, config, "constructor_standings").collect()
    assert [(r.race_year, r.constructor_id) for r in leaders] == [
        (2004, 1), (2003, 2), (2003, 3), (2002, 1), (2001, 1)]
    top = readback(spark, config, "driver_career").collect()
    assert [r.driver_id for r in top][:3] == [1, 2, 3]
    for table in READBACKS:
        assert readback(spark, config, table).count() >= 0


def test_command_line(spark, tmp_path):
    from strata.plans.pipeline import main
    root = write_fixtures(str(tmp_path / "raw"))
    args = ["--env", "prod", "--catalog-base", "cli", "--source-root", root,
            "--warehouse-root", str(tmp_path / "wh")]
    assert main(args) == 0
    assert read_table(spark, "cli_prod_gold.season_champions").count() == 4
    assert main(args + ["--reset"]) == 0
    assert not spark.catalog.databaseExists("cli_prod_gold")
