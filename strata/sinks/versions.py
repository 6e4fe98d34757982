"""Refreshes that leave the old rows readable until the new ones are complete.

Every refresh writes a folder of its own below the table's location. Only when the write has
succeeded and the rows read back satisfy the contract and the caller's check is the
table's name, a view, pointed at the new folder: one catalog operation. A refresh that fails, or
one that runs beside another, leaves the name on a complete version. Readers that began before
the switch go on reading their folder, so the previous version stays; older ones go.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sinks.tables import check_contract
from strata.sources.tables import quote_name

KEEP = 2


def _file_system(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf), where


def _has_files(spark: SparkSession, folder: str) -> bool:
    fs, where = _file_system(spark, folder)
    files = fs.listFiles(where, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def versions(spark: SparkSession, location: str) -> list[str]:
    """Complete versions below a location, the latest first."""
    fs, where = _file_system(spark, location)
    if not fs.exists(where):
        return []
    found = []
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        marker = _file_system(spark, f"{location}/{name}/_SUCCESS")[1]
        if name.startswith("v-") and fs.exists(marker):
            found.append(name)
    return sorted(found, reverse=True)


def refresh_table(df: DataFrame, table: str, location: str, *, partition_by: Sequence[str] = (),
                  contract: T.StructType | None = None, check: Callable[[DataFrame], None] | None = None,
                  keep: int = KEEP) -> str:
    """Write a new version of ``table`` and switch to it; returns the version's name. ``check`` gets
    the rows as written and raises to refuse them."""
    spark = df.sparkSession
    location = location.rstrip("/")
    if contract is not None:
        check_contract(df, contract, name=table)
    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{location}/{name}"
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    # the folder's own column order ends with the partition columns
    written = spark.read.schema(df.schema).parquet(folder).select(*[f"`{c}`" for c in df.columns])
    try:
        if contract is not None:
            check_contract(written, contract, name=table)
        if check is not None:
            check(written)
    except Exception:
        _delete(spark, folder)
        raise
    # a partitioned version without rows has no file that tells its columns
    rows = f"parquet.`{folder}`" if _has_files(spark, folder) else None
    value = lambda f: f"`{f.name}`" if rows else "NULL"
    fields = ", ".join(f"CAST({value(f)} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW {quote_name(table)} AS SELECT {fields} " + (f"FROM {rows}" if rows else "WHERE false"))
    _remove_old(spark, location, name, keep)
    return name


def _remove_old(spark: SparkSession, location: str, current: str, keep: int) -> None:
    """Complete versions before the current one and the ``keep`` - 1 before it are removed. Folders
    without a success marker may still be written by another refresh and stay."""
    older = [v for v in versions(spark, location) if v < current]
    for name in older[keep - 1:]:
        _delete(spark, f"{location}/{name}")


def _delete(spark: SparkSession, folder: str) -> None:
    fs, where = _file_system(spark, folder)
    fs.delete(where, True)
