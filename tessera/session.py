"""Session helpers.

Jobs run inside whatever ``SparkSession`` the caller owns.  The only
settings this library needs are set here for tests and local runs; on a
cluster the cluster's own settings win (nothing is overwritten when
already set).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for.  AQE coalesces the small
# shuffle outputs of the star-schema joins and splits skewed join keys.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.ansi.enabled", "true")
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared folder set by the cluster owner and is
    used as is.  Only a local master gets a fresh scratch folder when it is
    unset; anywhere else that is an error, as executors don't share the
    driver's folders.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — a Spark Connect session has no SparkContext:
        return conf_dir  # the server side uses spark.checkpoint.dir as configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001 — some deployments reject runtime core confs
        pass
    return path


def held(df: DataFrame) -> DataFrame:
    """``df`` computed once: written as Parquet into the shared checkpoint
    folder and read back.  An eager checkpoint would run the last stage twice,
    once to count and once to write."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/held-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
