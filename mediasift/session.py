"""Session helpers: a local session for tests/bench and checkpoint handling."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "mediasift") -> SparkSession:
    """Local session with the settings the tests and bench rely on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MEDIASIFT_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    Uses the directory already set on the context or ``spark.checkpoint.dir``.
    Only a local-mode session without either gets a scratch folder of its own;
    a cluster session without a configured shared folder is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="mediasift-ckpt-", dir="/tmp")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    One job, a flat plan afterwards, and the data survives executor loss.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/mediasift-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
