"""Session helpers: a local session for tests and benches, the shared checkpoint folder, scratch folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fulltime") -> SparkSession:
    """Local session used by tests, bench and the oracle check.

    AQE stays on so shuffle partitions coalesce and skewed joins split at run time; the UI stays off. A
    checkpoint folder is made only where the configuration names none: a local session shares it with itself.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # jobs of several threads (model folds) share the cores instead of queueing
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Skip per-call origin capture in PySpark (several JVM round trips per column function).
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not _configured(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fulltime-ckpt-", dir=os.environ.get("FULLTIME_SCRATCH")))
    return spark


def _configured(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; it must be named, as no local folder is shared with executors."""
    root = _configured(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


_MADE: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared checkpoint folder for written intermediate tables and stream state."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: its lineage ends there."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this application made (results read from them end with it); their number."""
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in made:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(made)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` to the shared checkpoint folder (reliable, survives executor loss)
    and continue from the written copy. Used before iterative work (model fits, folds)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
