"""Layer namespaces, schema contracts and idempotent overwrites.

Tables are Parquet (no Delta jar is assumed). Each layer is a database named
``<catalog_base>_<env>_<layer>`` located under the warehouse root, so dropping
a layer with CASCADE removes its managed files too. Writes are full
overwrites: running a load twice leaves exactly the second result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources.tables import quote_name


class ContractViolation(ValueError):
    pass


def check_contract(df: DataFrame, contract: T.StructType, *, name: str = "table") -> DataFrame:
    """Column names, order and types must equal the declared contract (nullability
    is not compared: file sources always report nullable columns)."""
    actual = [(f.name, f.dataType) for f in df.schema.fields]
    expected = [(f.name, f.dataType) for f in contract.fields]
    if actual != expected:
        raise ContractViolation(f"{name}: schema {actual} differs from contract {expected}")
    return df


def create_layer(spark: SparkSession, database: str, location: str | None = None) -> None:
    sql = f"CREATE DATABASE IF NOT EXISTS {quote_name(database)}"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table, or the view that a versioned table is."""
    is_view = spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW"
    spark.sql(f"DROP {'VIEW' if is_view else 'TABLE'} IF EXISTS {quote_name(table)}")


def drop_layer(spark: SparkSession, database: str) -> None:
    """Drop a layer and every table in it (managed files are deleted)."""
    spark.sql(f"DROP DATABASE IF EXISTS {quote_name(database)} CASCADE")


def use_layer(spark: SparkSession, database: str) -> None:
    spark.sql(f"USE {quote_name(database)}")


def current_namespace(spark: SparkSession) -> tuple[str, str]:
    row = spark.sql("SELECT current_catalog() AS c, current_schema() AS s").first()
    return row.c, row.s


def list_layers(spark: SparkSession, pattern: str = "*") -> list[str]:
    """``SHOW SCHEMAS LIKE pattern``."""
    return [r[0] for r in spark.sql(f"SHOW SCHEMAS LIKE '{pattern}'").collect()]


def overwrite_table(df: DataFrame, table: str, *, partition_by: Sequence[str] = (),
                    contract: T.StructType | None = None) -> None:
    """``write.mode("overwrite").saveAsTable`` as Parquet, optionally partitioned.

    Before a partitioned write the rows are rebalanced on the partition
    columns (``REBALANCE`` hint). AQE then splits a skewed season into several
    tasks and merges tiny ones, so each season directory gets a few
    right-sized files rather than one file per task or one giant task.
    """
    if contract is not None:
        check_contract(df, contract, name=table)
    writer_df = df
    if partition_by:
        writer_df = df.hint("rebalance", *partition_by)
    writer = writer_df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(quote_name(table))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Interactive peek (an extra job when acted on, so never part of a load)."""
    return df.limit(n)
