"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Run-time settings; safe to apply to a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings: UTC time, adaptive execution, skew-join splitting."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark. On a cluster use the one spark-submit gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and everything runs
    on this machine (tests, a laptop) a temporary folder is made and remembered for the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A path under the scratch folder that nothing else uses."""
    return f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex[:12]}"
