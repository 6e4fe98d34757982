"""The 20-table refresh: raw CSV -> bronze -> silver -> gold, in one session.

Every table is written once (one action per table) and the next layer reads
the written table, not the in-memory plan. That cuts lineage at each layer, so
a lost executor only recomputes from the last written table. The order is the
dependency order of the modelled job, with season_champions also waiting for
dim_drivers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import project, with_audit_column
from strata.operators.audit import assert_single_dimension_keys, key_audit
from strata.plans import gold, schemas, silver
from strata.sinks.tables import create_layer, drop_layer, drop_table, overwrite_table
from strata.sinks.versions import refresh_table
from strata.sources.csv import header_errors, ingest, read_csv_positional, source_path
from strata.sources.tables import read_table, sql_readback

ENVIRONMENTS = ("dev", "prod")
LAYERS = ("bronze", "silver", "gold")
ENTITIES = ("circuits", "constructors", "drivers", "races", "results", "driver_standings",
            "status")


@dataclass(frozen=True)
class PipelineConfig:
    env: str = "dev"
    catalog_base: str = "strata"
    source_root: str = ""
    warehouse_root: str = ""
    id_type: T.DataType = schemas.INT     # LongType() for keys beyond 32 bits
    versioned: bool = False               # refreshes that leave the old rows readable if they fail

    def __post_init__(self):
        object.__setattr__(self, "env", self.env.strip().lower())
        object.__setattr__(self, "catalog_base", self.catalog_base.strip().lower())
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"env must be one of {ENVIRONMENTS}, got {self.env!r}")
        if not self.catalog_base:
            raise ValueError("catalog_base must not be empty")
        if self.versioned and not self.warehouse_root:
            raise ValueError("versioned tables need a warehouse_root")

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.catalog_base}_{self.env}_{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def location(self, layer: str) -> str | None:
        if not self.warehouse_root:
            return None
        return f"{self.warehouse_root.rstrip('/')}/{self.database(layer)}"


# ---- layers -------------------------------------------------------------------------
def create_layers(spark: SparkSession, config: PipelineConfig) -> None:
    for layer in LAYERS:
        create_layer(spark, config.database(layer), config.location(layer))


def reset_layers(spark: SparkSession, config: PipelineConfig) -> None:
    """Drop every table, then each layer database (CASCADE removes managed files)."""
    rejected = tuple(f"{e}_rejected" for e in ENTITIES)
    for layer, names in (("bronze", ENTITIES + rejected), ("silver", (*schemas.SILVER_COLUMNS, AUDIT_TABLE)),
                         ("gold", tuple(schemas.GOLD_COLUMNS))):
        if spark.catalog.databaseExists(config.database(layer)):
            for name in names:
                drop_table(spark, config.table(layer, name))
        drop_layer(spark, config.database(layer))


def write_table(df: DataFrame, config: PipelineConfig, layer: str, name: str,
                partition_by: Sequence[str] = (), contract: T.StructType | None = None) -> None:
    """Replace a table's rows: in place, or as a new version behind its name."""
    table = config.table(layer, name)
    if config.versioned:
        refresh_table(df, table, f"{config.location(layer)}/{name}", partition_by=partition_by, contract=contract)
    else:
        overwrite_table(df, table, partition_by=partition_by, contract=contract)


# ---- bronze -------------------------------------------------------------------------
def bronze_frame(spark: SparkSession, config: PipelineConfig, entity: str) -> DataFrame:
    raw = read_csv_positional(spark, source_path(config.source_root, entity),
                              schemas.raw_schema(entity, config.id_type))
    return with_audit_column(project(raw, schemas.BRONZE_RENAMES[entity]))


def quarantine_table(config: PipelineConfig, entity: str) -> str:
    return config.table("bronze", f"{entity}_rejected")


def load_bronze(spark: SparkSession, config: PipelineConfig, entity: str) -> dict[str, int]:
    """Write one bronze table and, beside it, the rows whose own key is null (missing or
    unparsable); silver leaves those out. Returns the number of nulls per key column,
    foreign keys included."""
    target = config.table("bronze", entity)
    with header_errors():
        write_table(bronze_frame(spark, config, entity), config, "bronze", entity,
                    schemas.BRONZE_PARTITIONS.get(entity, ()), schemas.bronze_schema(entity, config.id_type))
    written = read_table(spark, target)
    own, foreign = schemas.bronze_keys(entity)
    write_table(ingest(written, own).rejects, config, "bronze", f"{entity}_rejected")
    counts = written.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in own + foreign])
    return counts.first().asDict()


# ---- silver / gold ----------------------------------------------------------------------
def _read(spark, config, layer, name):
    return read_table(spark, config.table(layer, name))


def silver_frames(spark: SparkSession, config: PipelineConfig) -> dict:
    b = lambda n: ingest(_read(spark, config, "bronze", n),
                         schemas.bronze_keys(n)[0]).accepted
    return {
        "dim_circuits": lambda: silver.dim_circuits(b("circuits")),
        "dim_drivers": lambda: silver.dim_drivers(b("drivers")),
        "dim_constructors": lambda: silver.dim_constructors(b("constructors")),
        "dim_status": lambda: silver.dim_status(b("status")),
        "dim_races": lambda: silver.dim_races(b("races")),
        "fact_results": lambda: silver.fact_results(
            b("results"), _read(spark, config, "silver", "dim_races"),
            _read(spark, config, "silver", "dim_status")),
        "fact_driver_standings": lambda: silver.fact_driver_standings(
            b("driver_standings"), _read(spark, config, "silver", "dim_races")),
    }


def gold_frames(spark: SparkSession, config: PipelineConfig) -> dict:
    s = lambda n: _read(spark, config, "silver", n)
    g = lambda n: _read(spark, config, "gold", n)
    return {
        "constructor_career": lambda: gold.constructor_career(s("fact_results"),
                                                              s("dim_constructors")),
        "constructor_standings": lambda: gold.constructor_standings(s("fact_results"),
                                                                    s("dim_constructors")),
        "driver_career": lambda: gold.driver_career(s("fact_results"), s("dim_drivers")),
        "season_champions": lambda: gold.season_champions(s("fact_driver_standings"),
                                                          s("dim_drivers")),
        "constructor_dominance": lambda: gold.constructor_dominance(g("constructor_standings")),
        "drivers_without_title": lambda: gold.drivers_without_title(g("driver_career"),
                                                                    g("season_champions")),
    }


# Topological order (tables are the only hand-off between steps).
ORDER = [
    *[("bronze", e) for e in ENTITIES],
    ("silver", "dim_circuits"), ("silver", "dim_drivers"), ("silver", "dim_constructors"),
    ("silver", "dim_status"), ("silver", "dim_races"),
    ("silver", "fact_results"), ("silver", "fact_driver_standings"),
    ("gold", "constructor_career"), ("gold", "constructor_standings"),
    ("gold", "driver_career"), ("gold", "season_champions"),
    ("gold", "constructor_dominance"), ("gold", "drivers_without_title"),
]


AUDIT_TABLE = "key_audit"


def audit_keys(spark: SparkSession, config: PipelineConfig) -> None:
    """Orphans, nulls and duplicates of the keys of both facts, one pass over each, written to
    ``key_audit`` of the silver layer. Raises if a dimension's key repeats."""
    dims = {k: (_read(spark, config, "silver", d), k) for k, d in (
        ("race_id", "dim_races"), ("driver_id", "dim_drivers"), ("constructor_id", "dim_constructors"),
        ("status_id", "dim_status"))}
    results = key_audit(_read(spark, config, "bronze", "results"), ["result_id"], dims)
    standings = key_audit(_read(spark, config, "bronze", "driver_standings"), ["driverStandingsId"],
                          {"raceId": dims["race_id"], "driverId": dims["driver_id"]})
    write_table(results.withColumn("fact", F.lit("results")).unionByName(
        standings.withColumn("fact", F.lit("driver_standings"))), config, "silver", AUDIT_TABLE)
    assert_single_dimension_keys(_read(spark, config, "silver", AUDIT_TABLE), ["result_id", "driverStandingsId"])


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> dict[str, dict[str, int]]:
    """Full refresh of all 20 tables; returns the null keys of each ingest."""
    create_layers(spark, config)
    rejects: dict[str, dict[str, int]] = {}
    silver_specs = gold_specs = None
    for layer, name in ORDER:
        if layer == "bronze":
            rejects[name] = load_bronze(spark, config, name)
            continue
        if layer == "silver":
            silver_specs = silver_specs or silver_frames(spark, config)
            df = silver_specs[name]()
            contract = schemas.silver_schema(name, config.id_type)
            parts = schemas.SILVER_PARTITIONS.get(name, ())
        else:
            gold_specs = gold_specs or gold_frames(spark, config)
            df = gold_specs[name]()
            contract = schemas.gold_schema(name, config.id_type)
            parts = schemas.GOLD_PARTITIONS.get(name, ())
        write_table(df, config, layer, name, parts, contract)
        if name == "dim_races":
            # all dimensions are there, no fact is joined yet
            audit_keys(spark, config)
    return rejects


# The read-back each load is checked with: (layer, where, order by, limit).
READBACKS = {
    "results": ("bronze", None, (), None),
    "status": ("bronze", None, (), None),
    "dim_circuits": ("silver", None, (), None),
    "dim_constructors": ("silver", None, (), 20),
    "dim_drivers": ("silver", None, (), 20),
    "dim_races": ("silver", None, (), 20),
    "dim_status": ("silver", None, (), 20),
    "fact_driver_standings": ("silver", None, (), 20),
    "fact_results": ("silver", None, (), 20),
    "constructor_career": ("gold", None, ("total_points DESC", "constructor_id"), 20),
    "constructor_standings": ("gold", "season_rank = 1", ("race_year DESC", "constructor_id"),
                              None),
    "constructor_dominance": ("gold", None, ("streak_length DESC", "constructor_id"), None),
    "driver_career": ("gold", None, ("total_points DESC", "driver_id"), 20),
    "season_champions": ("gold", None, ("race_year DESC", "driver_id"), None),
    "drivers_without_title": ("gold", None, ("total_wins DESC", "driver_id"), 20),
}


def readback(spark: SparkSession, config: PipelineConfig, table: str) -> DataFrame:
    """The SQL read-back of one table (a LIMIT without ORDER BY is a preview)."""
    layer, where, order_by, limit = READBACKS[table]
    return sql_readback(spark, config.table(layer, table), where=where, order_by=order_by,
                        limit=limit)


def main(argv: list[str] | None = None) -> int:
    import argparse
    import json

    from strata.session import build_session

    parser = argparse.ArgumentParser(description="Full refresh: raw CSV -> bronze -> silver -> gold")
    parser.add_argument("--env", default="dev")
    parser.add_argument("--catalog-base", default="strata")
    parser.add_argument("--source-root", required=True, help="folder holding <entity>.csv")
    parser.add_argument("--warehouse-root", required=True, help="folder for layer databases")
    parser.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    parser.add_argument("--wide-keys", action="store_true", help="64-bit keys")
    parser.add_argument("--versioned", action="store_true", help="a failed refresh leaves the old rows readable")
    parser.add_argument("--reset", action="store_true", help="drop the three layers and exit")
    args = parser.parse_args(argv)
    config = PipelineConfig(env=args.env, catalog_base=args.catalog_base,
                            source_root=args.source_root, warehouse_root=args.warehouse_root,
                            id_type=T.LongType() if args.wide_keys else schemas.INT, versioned=args.versioned)
    spark = build_session(args.master)
    if args.reset:
        reset_layers(spark, config)
        return 0
    print(json.dumps({"rejects": run_pipeline(spark, config)}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
