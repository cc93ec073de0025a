"""Session helpers: local builder for tests/bench and checkpoint-dir resolution."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tillsight job relies on.  AQE re-plans joins at runtime from
# real shuffle sizes (broadcast only when the measured side is small) and
# splits skewed join partitions, which is how hot customers/orders are handled.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tillsight") -> SparkSession:
    """Build (or reuse) a local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # delete reliable checkpoint files once their DataFrame is unreachable
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SQL_DEFAULTS.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it on the context.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used.  Only a local-mode session without the setting (tests,
    bench) gets a private temporary folder; a cluster session without it is
    an error, because a machine-local folder cannot survive executor loss.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server applies spark.checkpoint.dir
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="tillsight-ckpt-",
                                      dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df):
    """Cut ``df``'s lineage with a reliable checkpoint (shared folder).

    The frame is cached while the checkpoint is written, so it is computed
    once rather than once for counting and again for writing; the cache is
    dropped afterwards and readers use the checkpoint files, which survive
    executor loss.
    """
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()
