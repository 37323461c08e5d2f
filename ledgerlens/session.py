"""Session helpers: a tuned SparkSession and the reliable checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "ledgerlens", shuffle_partitions: int | None = None) -> SparkSession:
    """Return (or create) a session configured for this library.

    On a cluster the session is usually created by the platform; ``getOrCreate`` then
    reuses it and the settings below only fill what is unset.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named in ``spark.checkpoint.dir``; only when it is unset
    (local runs and tests) fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stored(df: DataFrame) -> DataFrame:
    """The rows written once, as parquet in the checkpoint folder, for steps that read them more than once:
    as reliable as a checkpoint, but compressed, and a later step reads only the columns that it uses."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
