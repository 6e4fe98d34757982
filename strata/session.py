"""Session construction and the shared scratch location.

Scratch data (CSV exports, round-trip tables, stored intermediates) always goes
below the folder the cluster names in ``spark.checkpoint.dir`` so that every
executor can reach it. A machine-local temporary folder is only used by a local
master that has none set (tests); any other master must name one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints of intermediate tables are removed once no plan refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


class NoSharedFolder(RuntimeError):
    pass


def build_session(master: str | None = "local[8]", shuffle_partitions: int | None = None,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Session with the package defaults. ``master=None`` keeps the master given
    by spark-submit (cluster runs); the submitted number of shuffle partitions
    stays unless one is passed here."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """One process on one machine (``local-cluster`` has separate executors)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder: the configured one, or on a local master
    a temporary one. Raises ``NoSharedFolder`` elsewhere."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise NoSharedFolder(
                f"master {sc.master}: set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared checkpoint folder, removed when
    the application ends."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/strata-scratch/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, written as Parquet to the shared folder and read back:
    every later read sees the same values, and lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
