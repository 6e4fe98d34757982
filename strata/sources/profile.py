"""Profile of text columns: one pass, mergeable counts, exact types.

For every column the pass counts how many values fit each type of a small lattice
(int < bigint < double, date, timestamp, else text). Counts of several files or partitions
add up, and the type follows from the counts of the whole input, so no value outside
of a sample can turn null when the table is loaded with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNTS = ["rows", "nulls", "markers", "ints", "bigints", "wide_bigints", "doubles", "dates", "timestamps"]
_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(),
          "timestamp": T.TimestampType(), "string": T.StringType()}
_EXACT = 1 << 53             # integers up to here are doubles, too


def _counts(name: str, markers: Sequence[str]) -> list[Column]:
    x = F.col(f"`{name}`")
    marked = x.isin(list(markers)) if markers else F.lit(False)
    # a CSV reader takes no spaces around a number
    fits = lambda kind: F.col(f"`{name}`").try_cast(kind).isNotNull() & (x == F.trim(x)) & ~marked
    whole = x.rlike(r"^[+-]?\d+$")
    return [
        F.count(F.lit(1)), F.count_if(x.isNull()), F.count_if(marked),
        F.count_if(whole & fits("int")), F.count_if(whole & fits("bigint")),
        F.count_if(whole & fits("bigint") & (F.abs(x.try_cast("decimal(20,0)")) > _EXACT)),
        F.count_if(fits("double") & x.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")),
        F.count_if(fits("date") & x.rlike(r"^\d{4}-\d{2}-\d{2}$")),
        F.count_if(fits("timestamp") & x.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}")),
    ]


def column_counts(texts: DataFrame, markers: Sequence[str] = ()) -> DataFrame:
    """One row per column (all of text type) with ``COUNTS``, from one aggregate."""
    structs = [F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"),
                        *[c.alias(n) for n, c in zip(COUNTS, _counts(name, markers))])
               for i, name in enumerate(texts.columns)]
    return texts.agg(F.array(*structs).alias("all")).select(F.inline("all"))


def merge_counts(*profiles: DataFrame) -> DataFrame:
    """The profile of all inputs together."""
    union = profiles[0]
    for other in profiles[1:]:
        union = union.unionByName(other)
    return union.groupBy("position", "column").agg(*[F.sum(c).alias(c) for c in COUNTS])


def with_types(counts: DataFrame, *, markers_are_null: bool = False) -> DataFrame:
    """``counts`` with type, the least one that holds every value. Integers join doubles only
    where these hold them exactly. Markers are text unless the load reads them as null."""
    values = F.col("rows") - F.col("nulls") - (F.col("markers") if markers_are_null else F.lit(0))
    kind = (F.when(values == 0, "string").when(F.col("ints") == values, "int").when(F.col("bigints") == values, "bigint")
            .when((F.col("doubles") == values) & (F.col("wide_bigints") == 0), "double")
            .when(F.col("dates") == values, "date").when(F.col("timestamps") == values, "timestamp").otherwise("string"))
    return counts.withColumn("type", kind)


def read_text_columns(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A CSV file's columns as text, named by its header."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def profile_schema(profile: DataFrame) -> T.StructType:
    """The typed schema of a profile (one row a column goes to the driver)."""
    return T.StructType([T.StructField(r["column"], _TYPES[r["type"]]) for r in profile.orderBy("position").collect()])
