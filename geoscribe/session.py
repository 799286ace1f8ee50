"""Session construction and shared scratch locations.

On a cluster the caller owns the SparkSession; ``build_session`` is only the
configuration we use for tests and the local benchmark.  Scratch output (sink
round trips, streaming checkpoints) always goes below ``spark.checkpoint.dir``,
which a cluster points at shared storage.  Only when that setting is absent (a
local test run) do we create one of our own.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "geoscribe", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect client: only the session conf is visible
        configured = spark.conf.get(CHECKPOINT_CONF, None)
        if not configured:
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder") from None
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    if not configured:
        if not sc.master.startswith("local"):
            # A machine-local folder is not shared by executors on a cluster.
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder on shared storage")
        # Local mode (tests, local bench) with nothing named: a local folder is shared.
        configured = tempfile.mkdtemp(prefix="geoscribe-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark)}/geoscribe/{name}-{uuid.uuid4().hex}"


@contextmanager
def lean(spark: SparkSession):
    """Within it, queries drop their shuffle files as they end and hand Arrow batches of ``BATCH_BYTES`` to Python.

    Without, shuffle files stay until the driver collects its garbage, so a chain of
    intermediates holds all its exchanges on disk at once; and a batch of 10 000 long
    texts takes off-heap memory several times its size in each task.  The caller's
    settings hold again afterwards, and a smaller batch of theirs stays.
    """
    wanted = {CLEANUP_CONF: "true", BATCH_CONF: str(BATCH_BYTES)}
    old = {key: spark.conf.get(key, None) for key in wanted}
    try:
        current = int(old[BATCH_CONF])
    except (TypeError, ValueError):                        # unset, or with a unit
        current = -1
    if 0 < current < BATCH_BYTES:
        del wanted[BATCH_CONF]
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in wanted:
            if old[key] is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, old[key])


def materialize(df, name: str = "intermediate"):
    """Write ``df`` once as parquet under the shared checkpoint directory and read it back.

    Used where one intermediate feeds several branches of a plan whose column
    pruning differs per branch (so Spark cannot reuse the exchange) and is too
    costly to recompute.  It cuts the lineage, so a lost executor does not send
    the chain back to the scan, and the re-read carries real file sizes for the
    optimizer's broadcast decisions.  (``Dataset.checkpoint`` would compute the
    data twice: once for its count and once more to write the files.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with lean(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
