"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from strata.session import ensure_checkpoint_dir, scratch_path

# Texts travel to Python in batches bounded by bytes as well as by rows, so a
# run of very long texts does not make a batch larger.
BATCH_ROWS = 1024
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches, for the rest of the session (columns are built before they run), and
    make sure a shared checkpoint folder is set."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def free_name(base: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has (names compare case-insensitively)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def text_of(df: DataFrame, name: str) -> Column:
    """The text column as a string, null as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def arrow_column(fn: Callable[..., pa.Array], result: DataType | str) -> Callable[..., Column]:
    """Scalar Arrow UDF from a plain function over Arrow arrays.

    Only the argument columns travel to Python; the other columns of the row
    stay in the JVM."""
    from inspect import signature

    if len(signature(fn).parameters) == 1:
        def run(a: pa.Array) -> pa.Array:
            return fn(a)
    else:
        def run(a: pa.Array, b: pa.Array) -> pa.Array:
            return fn(a, b)
    run.__annotations__ = {k: pa.Array for k in run.__annotations__}
    return F.arrow_udf(run, returnType=result)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Scratch:
    """Stored tables of one computation: removed when it ends. What outlives it is
    stored elsewhere."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.parquet(path)

    def measured(self, df: DataFrame, name: str, *measures: Column) -> tuple[DataFrame, dict]:
        """``df`` stored, and these aggregates of it, taken while it is written."""
        seen = Observation()
        return self.store(df.observe(seen, *measures), name), seen.get

    def drop(self, *names: str) -> None:
        """Remove the tables stored under these names: nothing reads them any more."""
        self.remove([path for path in self.paths if path.rpartition("/")[2].rpartition("-")[0] in names])

    def remove(self, paths: list[str]) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        self.paths = [path for path in self.paths if path not in paths]

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.remove(self.paths)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark removes an execution's shuffle files when that execution ends; otherwise they
    stay until the driver happens to collect its garbage. For steps that store what they make."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


# Values (of up to 8 bytes) up to which a stored table may be broadcast.
BROADCAST_VALUES = 1_000_000


def small(table: DataFrame, values: Column | None = None) -> DataFrame:
    """A stored table, marked for broadcast if it is counted to hold few values
    (``values`` per row; by default one a column, for fixed-width columns)."""
    values = F.lit(len(table.columns)) if values is None else values
    held = table.agg(F.sum(values)).first()[0] or 0
    return F.broadcast(table) if held <= BROADCAST_VALUES else table


def read_tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]
