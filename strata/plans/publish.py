"""Publishing recomputed tables so that readers never see a gap.

A published name is a view. Every publish writes a table of its own first and
then points the view at it, in one catalog call; a publish that fails before
that call leaves the view on the table it had.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

#: Names of the tables behind the views start so; the published name follows.
VERSION_PREFIX = "version_of_"
_PROPERTY = "strata.version"


def _split(name: str) -> tuple[str, str]:
    database, _, table = name.rpartition(".")
    return (f"{database}." if database else ""), table


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def current_version(spark: SparkSession, name: str) -> str | None:
    """The table that a published name stands for; None if it is not published this way."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "VIEW":
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return next((r.value for r in rows if r.key == _PROPERTY), None)


def publish(
    df: DataFrame, name: str, comment: str = "", fmt: str = "parquet", partition_by: tuple[str, ...] = (),
    bucket_by: tuple[int, str] | None = None,
) -> DataFrame:
    """Write ``df`` as the new version of the fully recomputed table ``name`` and return the table.

    Readers see the old version whole until the new one is written, and the new
    one whole from then on. The version before stays for readers that have
    planned on it; older ones, and those of failed publishes, are dropped. A plain
    table of that name is replaced by the view once its successor is written.

    ``partition_by`` lays the table out in folders by low-cardinality columns
    (no shuffle: each task writes its rows to their folders), so readers that
    filter on them prune whole folders. ``bucket_by=(n, column)`` deals the rows into
    ``n`` buckets, one task a bucket: readers that group or join by the column,
    with a table of as many buckets, need no exchange. A value that holds a large
    share of the rows makes one large bucket, so it is for columns without one.
    """
    spark = df.sparkSession
    database, table = _split(name)
    before = current_version(spark, name)
    version = f"{database}{VERSION_PREFIX}{table}_{uuid.uuid4().hex}"
    writer = (df.repartition(*bucket_by) if bucket_by else df).write.mode("errorifexists").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(version)
    if comment:
        spark.sql(f"COMMENT ON TABLE {version} IS '{_quoted(comment)}'")
    if before is None and spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {name}")
    note = f" COMMENT '{_quoted(comment)}'" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{note} TBLPROPERTIES ('{_PROPERTY}' = '{version}') AS SELECT * FROM {version}")
    keep = {_split(v)[1] for v in (version, before) if v}
    shown = spark.sql(f"SHOW TABLES {'IN ' + database[:-1] if database else ''} LIKE '{VERSION_PREFIX}{table}_*'").collect()
    old = [r.tableName for r in shown if len(r.tableName) == len(VERSION_PREFIX) + len(table) + 33]
    for other in old:
        if other not in keep:
            spark.sql(f"DROP TABLE IF EXISTS {database}{other}")
    return spark.read.table(name)


def publish_together(spark: SparkSession, jobs: Iterable[Callable[[], DataFrame]], at_once: int = 4) -> list[DataFrame]:
    """Run publishes that do not read each other side by side; results in order, the first error is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [w.result() for w in waiting]
