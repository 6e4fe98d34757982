"""Table scans by qualified name and SQL read-back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def quote_name(name: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def read_table(spark: SparkSession, qualified_name: str) -> DataFrame:
    return spark.table(quote_name(qualified_name))


def sql_readback(spark: SparkSession, qualified_name: str, *, where: str | None = None,
                 order_by: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """``SELECT * FROM t [WHERE ...] [ORDER BY ...] [LIMIT n]`` through the SQL parser."""
    sql = f"SELECT * FROM {quote_name(qualified_name)}"
    if where:
        sql += f" WHERE {where}"
    if order_by:
        sql += " ORDER BY " + ", ".join(order_by)
    if limit is not None:
        sql += f" LIMIT {int(limit)}"
    return spark.sql(sql)


def read_parquet_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
