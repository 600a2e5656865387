"""Session helpers: building a session, the shared work folder, durable lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(app: str = "lexivane", cpus: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the session you are given."""
    cpus = cpus or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a fresh folder in /tmp; on a cluster a missing
    setting is an error, because a machine-local folder would not survive executor loss.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="lexivane-")
    spark.conf.set(CHECKPOINT_KEY, base)
    return base


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/lexivane-{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and go on from there.

    Cuts lineage, survives the loss of executors, keeps later reads to the columns they
    need, and gives the optimizer the true size of the table for its join choices.
    """
    spark = df.sparkSession
    path = work_dir(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a scan that comes in fewer partitions than there are cores.

    Text work is CPU-bound, so a single small file should not keep one core busy and the
    rest idle. A scan with enough splits is left as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)
