"""Helpers shared by the operators of this subpackage.

Plain Spark helpers only: reliable checkpoints, sums that stay on the
executors, running offsets over a fixed number of buckets, and connected
components by stars.
"""

from __future__ import annotations

import gc
import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.session import checkpoint_dir


#: Bytes of a batch that goes to a Python worker, where the session leaves Spark's own bound of 64 MB.
BATCH_BYTES = 4 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def with_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and bound the batches they get by bytes.

    Needed where the driver found it by a path of its own, as in a local run;
    on a cluster the executors have it installed or through ``--py-files``.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    if spark.conf.get(_BATCH_SETTING) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, whole. Spark opens the path, so any store it knows works."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame, partitioned: bool = False) -> DataFrame:
    """Eager reliable checkpoint in the shared folder of ``spark.checkpoint.dir``.

    With ``partitioned`` the result still counts as dealt out the way ``df``
    is (by its last ``repartition``), so later grouping by those columns does
    not deal it again. Spark knows this of plans without adaptive execution
    only, which is therefore off while this one frame is written.

    Only a local session without that setting gets a folder of its own; a
    cluster without it is an error, because a machine-local folder would not
    outlive an executor.
    """
    spark = df.sparkSession
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-llm-"))
    else:
        checkpoint_dir(spark)
    if not partitioned:
        return df.checkpoint(eager=True)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # a plan of its own: the one of ``df`` may have been made under the other setting
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def release(spark: SparkSession) -> None:
    """Have the driver collect garbage, so that Spark deletes the shuffle files of frames that are gone.

    Spark deletes a shuffle when the last frame that reads it is collected;
    after a checkpoint has replaced a large shuffle, waiting for a collection
    by chance would keep both on disk.
    """
    gc.collect()
    jvm = getattr(spark.sparkContext, "_jvm", None)
    if jvm is not None:
        jvm.System.gc()


def fresh(df: DataFrame) -> DataFrame:
    """The same columns under new identities, so that two frames of one lineage can be cogrouped."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_number(
    df: DataFrame, order: list[str], out: str, *, within: list[str] | None = None, deal: list[str] | None = None,
    groups: int = 256, weight: str | None = None, bucket: Column | None = None,
) -> DataFrame:
    """Number the rows of ``df`` (or of each ``within`` group) from 0, without gaps.

    Rows are dealt to ``groups`` squared hash buckets of the ``deal`` columns
    (default ``order``), so even a third of 100 TB makes buckets of about half a
    GB. A bucket's offset is the sum of the buckets before it, taken in two
    levels (``groups`` groups of ``groups`` buckets), so that no task sums more
    than ``groups`` rows of a group; rows are ranked by ``order`` inside their
    bucket only. With ``weight`` the number is the sum of the weights before the row
    instead of their count. With ``bucket``, a long from 0 that never falls along
    ``order``, rows are dealt by it and the numbers follow ``order`` throughout.
    Rows that are equal under ``order`` should be equal
    in all columns; the numbering is then reproducible. ``within`` columns must
    hold no nulls.

    Besides its rows, ``df`` is read for its ``within``, ``deal`` and ``weight``
    columns.
    """
    within = within or []
    b, g, size = "__bucket", "__group", F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    rows = df.withColumn(b, F.pmod(F.xxhash64(*(deal or order)), F.lit(groups * groups)).cast("int") if bucket is None else bucket)
    sums = rows.groupBy(*within, b).agg(F.sum(size).alias("__sum")).withColumn(g, F.floor(F.col(b) / groups).cast("long"))
    earlier = lambda keys, by: F.coalesce(
        F.sum("__sum").over(W.partitionBy(*(keys or [F.lit(0)])).orderBy(by).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    bases = sums.groupBy(*within, g).agg(F.sum("__sum").alias("__sum")).select(*within, g, earlier(within, g).alias("__base"))
    offsets = sums.withColumn("__in", earlier([*within, g], b)).join(bases, [*within, g]).select(
        *within, b, (F.col("__base") + F.col("__in")).alias("__offset")
    )
    inside = W.partitionBy(*within, b).orderBy(*order)
    if weight is None:
        local = F.row_number().over(inside) - 1
    else:
        local = F.coalesce(F.sum(size).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = rows.withColumn("__local", local)
    numbered = ranked.join(offsets, [*within, b])
    return numbered.withColumn(out, (F.col("__offset") + F.col("__local")).cast("long")).drop(b, "__offset", "__local")


def components(edges: DataFrame) -> DataFrame:
    """Connected components: (node, component), component the smallest node id.

    ``edges`` has long columns ``a`` and ``b``. Edges are kept larger end first
    and rewired by turns (alternating large-star and small-star): the larger
    ends of a node's edges go to the smallest neighbour of that node, then a
    node's smaller neighbours go to the smallest of them. So whole trees hook
    onto smaller roots, in rounds that grow with the logarithm of the longest
    chain, whatever the order of ids along it. It goes on until every edge
    leads from a node straight to its root; no number of rounds is given up at.

    Smallest neighbours are kept before they are joined, so that adaptive
    execution can split a node with very many edges. Each round lets the shuffles
    of the one before go, so that disk does not grow with the rounds.
    """
    spark = edges.sparkSession
    edges = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        low = _smallest(edges)
        up = low.select(F.col("a").alias("b"), F.col("low").alias("up"))
        if low.filter("n > 1").isEmpty() and edges.join(up, "b", "left_semi").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        edges = checkpointed(edges.join(up, "b", "left").select("a", F.coalesce("up", "b").alias("b")).distinct())
        tied = edges.join(_smallest(edges), "a")
        edges = checkpointed(
            tied.select("a", F.col("low").alias("b")).union(tied.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))).distinct()
        )
        del low, up, tied
        release(spark)


def _smallest(edges: DataFrame) -> DataFrame:
    """Per larger end: its smallest neighbour and its number of edges."""
    return checkpointed(edges.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n")))
