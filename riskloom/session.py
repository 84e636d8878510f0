"""Session construction and the shared checkpoint folder.

Library code never changes the configuration of a session it is handed; only
``build_session`` (used by tests, the bench and command-line runs) sets options.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8, app_name: str = "riskloom") -> SparkSession:
    """Session for local runs; on a cluster the submitter's settings win."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.optimizer.dynamicPartitionPruning.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.ui.enabled", "false")
        # Python call-site capture for error messages costs several py4j round trips per
        # Column function; wide generated plans pay seconds of driver time for it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to a shared file system; we only pick a
    folder of our own when it is unset and the master is local (tests and the bench).
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share; {sc.master} is not local")
        configured = tempfile.mkdtemp(prefix="riskloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(CHECKPOINT_CONF, configured)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder under a name of its own, and read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
