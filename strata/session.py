"""Session helpers.

On a cluster the session comes from the platform; these helpers only fill
in settings that are unset, so cluster configuration always wins.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. Applied only where the session has no value.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark 4.1 takes a union of frames partitioned by the same keys for
    # partitioned by them itself, and a window over it returns several rows a key.
    "spark.sql.unionOutputPartitioning": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """A local session for tests and the bench; UI off, UTC, AQE on.

    The checkpoint folder is a fresh temp folder only because a local run
    has no shared storage; clusters name theirs in ``spark.checkpoint.dir``.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strata-ckpt-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-wh-"))
        # Broadcast only sizes that AQE has measured, never the planner's guess
        # from compressed file sizes.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set library defaults on an existing session where they are unset."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


def use_measured_broadcast(spark: SparkSession, adaptive_threshold: str = "32m") -> SparkSession:
    """Broadcast only sizes that are measured: turn off the planner's broadcast
    guess from file statistics and let AQE broadcast a side whose materialised
    shuffle output is under ``adaptive_threshold``."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive_threshold)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Reads the session's setting (the cluster names it); under Spark Connect,
    where there is no local SparkContext, the server applies it itself.
    Raises when none is named: a machine-local fallback would not survive
    executor loss on a cluster.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        if configured:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
    elif configured:
        return configured
    raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for reliable checkpoints")


def scratch_folder(spark: SparkSession) -> str:
    """A folder for files of a run: inside ``spark.checkpoint.dir``, or a temp
    folder where a local session names none. A cluster must name one."""
    return f"{any_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"


def any_checkpoint_dir(spark: SparkSession) -> str:
    """``checkpoint_dir``; a local session that names none gets a temp folder. A cluster must name one."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-scratch-"))
        return checkpoint_dir(spark)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A ``scratch_folder`` that is deleted at the end of the block."""
    folder = scratch_folder(spark)
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage into the shared checkpoint folder.

    Used where a plan is read twice around a side effect (log append) so the
    second read sees the same rows, and where lost executors must not force
    recomputation from the sources.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
