"""CSV exports derived from the test tables, in the raw races layout.

They feed the CSV ingest queries with the traits of the real source files:
a header row, one extra trailing column (``source``), ``\\N`` markers, quoted
commas, and keys that do not parse. Written by Spark (one file per task) to a
fresh path under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources.standins import StandInTables

def races_export_frame(tables: StandInTables) -> DataFrame:
    """All orders (pending ones included) as raw race rows, every value text.

    Pending low-priority orders get an unparsable key (``x<key>``), pending
    orders get ``\\N`` for time and circuit."""
    o = tables.table("orders")
    pending = F.col("o_orderstatus") == "P"
    key = F.col("o_orderkey").cast("string")
    bad_key = pending & (F.col("o_orderpriority") == "5-LOW")
    return o.select(
        F.when(bad_key, F.concat(F.lit("x"), key)).otherwise(key).alias("raceId"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.month("o_orderdate").cast("string").alias("round"),
        F.when(pending, F.lit("\\N")).otherwise(F.col("o_custkey").cast("string"))
        .alias("circuitId"),
        F.concat_ws(", ", "o_orderpriority", "o_orderstatus").alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(pending, F.lit("\\N")).otherwise(F.lit("12:00:00")).alias("time"),
        F.concat(F.lit("http://example.org/races/"), key).alias("url"),
        F.lit("testdata").alias("source"))


def export_races_csv(tables: StandInTables, entity: str | None = None) -> str:
    """Folder of the export; with ``entity``, ``<fresh folder>/<entity>.csv``."""
    path = scratch_path(tables.spark, "races-csv")
    path = f"{path}/{entity}.csv" if entity else path
    (races_export_frame(tables).write.mode("overwrite")
     .option("header", True).option("escape", '"').csv(path))
    return path
