"""Append-only ingestion log: latest state, latest success, landing and removal
records, and the whole incremental step.

The log has the columns of ``MANIFEST_SCHEMA``; the item identity is
``keys`` (default ``source, file_name``). Every step is a set-based plan; no
rows are collected to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.changes import action_counts, classify_changes, detect_removed
from strata.operators.latest import latest_by_key
from strata.operators.quality import require_non_empty
from strata.plans.runs import RUN_COLUMNS, BucketedState, Run, visible_rows
from strata.schemas import CHANGED, FAILED, MANIFEST_SCHEMA, NEW, REAPPEARED, REMOVED, SUCCESS, UNCHANGED
from strata.session import materialize

KEYS = ("source", "file_name")
TRACK = ("file_size", "source_modified_time")


def _now(now) -> Column:
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now)


def _rest(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Remaining columns, by name, as final tie-breakers: the pick is
    deterministic and independent of the physical column order (a table
    partitioned by ``source`` lists it last)."""
    return [F.col(c).desc_nulls_last() for c in sorted(df.columns) if c not in used]


def latest_state(log: DataFrame, keys: Sequence[str] = KEYS, time_col: str = "ingestion_time") -> DataFrame:
    """Newest log row per item, whatever its status."""
    order = [F.col(time_col).desc()] + _rest(log, [*keys, time_col])
    return latest_by_key(log, keys, order)


def latest_success(
    log: DataFrame,
    keys: Sequence[str] = KEYS,
    version_col: str = "source_modified_time",
    time_col: str = "ingestion_time",
    status_col: str = "status",
) -> DataFrame:
    """Per item, the SUCCESS row with the newest source version (NULL version
    last), then the newest ingestion. A source rolled back to an older version
    never wins, so such an item stays CHANGED."""
    ok = log.filter(F.col(status_col) == SUCCESS)
    order = [F.col(version_col).desc_nulls_last(), F.col(time_col).desc()] + _rest(ok, [*keys, version_col, time_col])
    return latest_by_key(ok, keys, order)


def removed_records(removed: DataFrame, now=None, columns: Sequence[str] | None = None) -> DataFrame:
    """Log rows for removed items: status REMOVED, a new ingestion time, all else carried over."""
    cols = list(columns or MANIFEST_SCHEMA.fieldNames())
    fixed = {"status": F.lit(REMOVED), "ingestion_time": _now(now)}
    return removed.select(*[fixed.get(c, F.col(c)).alias(c) for c in cols])


def landing_records(
    classified: DataFrame,
    landed: DataFrame,
    keys: Sequence[str] = ("file_name",),
    *,
    size_col: str = "file_size",
    landed_size: str = "length",
    landed_time: str = "modification_time",
    version_col: str = "source_modified_time",
    since_col: str = "prev_ingestion_time",
    action_col: str = "action",
    now=None,
) -> DataFrame:
    """One record per NEW/CHANGED (or REAPPEARED) item: SUCCESS when this version's file has landed
    (``size_col`` becomes its actual size; ``size_mismatch`` when that differs
    from the listed size, kept in ``listed_size``), otherwise FAILED with the
    listed size. A FAILED item stays NEW/CHANGED against the latest success,
    so the next run retries it.

    Where ``landed`` has ``landed_time``, a file counts only if it was written
    at or after the listed version (``version_col``) and after the item's last
    success was logged (``since_col``): the old copy of a changed file is not
    its new version. Without that column every landed file counts, so
    ``landed`` must then hold only what this run has landed.

    Several landed copies of one key (as in several folders) count as one: the
    newest, of these the largest; without times the largest. So an item always
    has one record.
    """
    todo = classified.filter(F.col(action_col).isin(NEW, CHANGED, REAPPEARED))
    dated = landed_time in landed.columns
    copy = F.max(F.struct(*([F.col(landed_time).alias("at")] if dated else []), F.col(landed_size).alias("size")))
    got = landed.groupBy(*keys).agg(copy.alias("copy")).select(
        *keys, F.col("copy.size").alias("__landed"), *([F.col("copy.at").alias("__landed_at")] if dated else [])
    )
    found = F.col("__landed").isNotNull()
    if dated:
        at = F.col("__landed_at")
        if version_col in todo.columns:
            found = found & F.coalesce(at >= F.col(version_col), F.lit(True))
        if since_col in todo.columns:
            found = found & F.coalesce(at > F.col(since_col), F.lit(True))
    return (
        todo.join(got, list(keys), "left")
        .withColumn("__found", found)
        .withColumn("listed_size", F.col(size_col))
        .withColumn("status", F.when(F.col("__found"), F.lit(SUCCESS)).otherwise(F.lit(FAILED)))
        .withColumn("size_mismatch", F.coalesce(F.col("__found") & (F.col("__landed") != F.col(size_col)), F.lit(False)))
        .withColumn(size_col, F.when(F.col("__found"), F.col("__landed")).otherwise(F.col(size_col)))
        .withColumn("ingestion_time", _now(now))
        .drop("__landed", "__landed_at", "__found")
    )


def content_records(
    classified: DataFrame,
    source: str,
    *,
    name_col: str = "file_name",
    path_col: str = "file_path",
    size_col: str = "file_size",
    action_col: str = "action",
    stored: DataFrame | None = None,
    keys: Sequence[str] = ("file_name",),
    hash_col: str = "content_sha256",
    now=None,
) -> DataFrame:
    """Log rows for content compared by bytes (``classify_content``): only
    NEW/CHANGED contents are logged, with no source time (the source publishes
    none). ``stored`` holds the digests found in storage after the write: a
    content whose digest is not there is FAILED. Without it the caller vouches
    for the write and all are SUCCESS."""
    todo = classified.filter(F.col(action_col) != UNCHANGED)
    status = F.lit(SUCCESS)
    if stored is not None:
        there = stored.select(*keys, F.col(hash_col).alias("__stored")).distinct()
        todo = todo.join(there, list(keys), "left")
        status = F.when(F.col("__stored") == F.col(hash_col), F.lit(SUCCESS)).otherwise(F.lit(FAILED))
    return todo.select(
        F.lit(source).alias("source"),
        F.col(name_col).alias("file_name"),
        F.col(path_col).alias("file_path"),
        F.col(size_col).cast("bigint").alias("file_size"),
        F.lit(None).cast("timestamp").alias("source_modified_time"),
        _now(now).alias("ingestion_time"),
        status.alias("status"),
    )


LOG_COLUMNS = [*MANIFEST_SCHEMA.fieldNames(), "listed_size"]


@dataclass
class StepResult:
    """Output of one incremental step (all lazy DataFrames)."""

    classified: DataFrame
    landed: DataFrame
    removed: DataFrame

    def records(self) -> DataFrame:
        """New log rows (landing records, then removals) with ``LOG_COLUMNS``."""
        return self.landed.select(*LOG_COLUMNS).unionByName(self.removed.select(*LOG_COLUMNS))

    def counts(self) -> DataFrame:
        return action_counts(self.classified)


def with_listed_size(log: DataFrame) -> DataFrame:
    """Logs written without ``listed_size`` compare on ``file_size``."""
    return log if "listed_size" in log.columns else log.withColumn("listed_size", F.col("file_size"))


def ingest_step(
    inventory: DataFrame,
    log: DataFrame,
    landed: DataFrame,
    source: str,
    target_dir: str = "",
    now=None,
    *,
    reappeared: bool = False,
    cut: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StepResult:
    """One run, side-effect free: classify the listing against the latest
    SUCCESS per file (listed size against listed size, and source time),
    build landing records from what was actually landed, and mark SUCCESS
    items gone from the listing as REMOVED.

    By default a file whose latest state is REMOVED and which comes back
    unchanged against its latest SUCCESS stays UNCHANGED: it is not landed
    again and its state stays REMOVED. ``reappeared=True`` labels it
    REAPPEARED and lands it like a NEW file, so its state returns to SUCCESS.

    ``inventory``: ``INVENTORY_SCHEMA``; ``landed``: ``(file_name, length)`` and,
    unless it holds this run's files only, ``modification_time`` (see
    ``landing_records``). Where it has ``relative_path`` (``list_files``,
    ``read_landed``), only files directly in the landing folder count, not those of
    the same name in folders below it. ``cut`` is applied to the two frames that are read
    more than once (``incremental_ingest`` checkpoints them).
    """
    log = with_listed_size(log).filter(F.col("source") == source)
    newest = cut(newest_rows(log, ["file_name"]))
    success, state = (newest.filter(f"{c} IS NOT NULL").select(F.col("file_name"), f"{c}.*") for c in ("success", "state"))
    prev = success.select(
        "file_name", F.col("listed_size").alias("file_size"), "source_modified_time", "ingestion_time"
    )
    classified = classify_changes(inventory, prev, ["file_name"], list(TRACK), carry=["ingestion_time"])
    if reappeared:
        gone = state.filter(F.col("status") == REMOVED).select("file_name", F.lit(True).alias("__gone"))
        classified = (
            classified.join(gone, ["file_name"], "left")
            .withColumn(
                "action",
                F.when((F.col("action") == UNCHANGED) & F.col("__gone").isNotNull(), F.lit(REAPPEARED))
                .otherwise(F.col("action")),
            )
            .drop("__gone")
        )
    classified = cut(classified)
    prefix = target_dir.rstrip("/") + "/" if target_dir else ""
    if "relative_path" in landed.columns:
        landed = landed.filter(F.col("relative_path") == F.col("file_name"))
    landing = landing_records(classified, landed, ["file_name"], now=now).select(
        F.lit(source).alias("source"),
        "file_name",
        F.concat(F.lit(prefix), F.col("file_name")).alias("file_path"),
        "file_size",
        "source_modified_time",
        "ingestion_time",
        "status",
        "listed_size",
        "size_mismatch",
    )
    removed = removed_records(detect_removed(state, inventory, ["file_name"]), now, LOG_COLUMNS)
    return StepResult(classified, landing, removed)


def empty_log(spark: SparkSession) -> DataFrame:
    """An empty log (manifest columns + ``listed_size``)."""
    return with_listed_size(spark.createDataFrame([], MANIFEST_SCHEMA))


def read_log(spark: SparkSession, table: str) -> DataFrame:
    """The log table's rows of committed runs, or an empty log when it does not exist yet."""
    if spark.catalog.tableExists(table):
        return visible_rows(spark, table).drop(*RUN_COLUMNS)
    return empty_log(spark)


def table_latest_state(spark: SparkSession, table: str, source: str) -> DataFrame:
    """Latest log row per file of one source, read from a log table (prunes to the source's folder)."""
    return latest_state(read_log(spark, table).filter(F.col("source") == source))


def table_latest_success(spark: SparkSession, table: str, source: str) -> DataFrame:
    """Latest SUCCESS row per file of one source, read from a log table."""
    return latest_success(read_log(spark, table).filter(F.col("source") == source))


def append_records(
    records: DataFrame, table: str, partition_by: Sequence[str] = (), buckets: int | None = None, run_id: str | None = None
) -> bool:
    """Append rows to a log table as one committed run; an empty input writes nothing. Returns whether rows were written.

    With a ``run_id`` the append happens once: repeated after its commit it
    writes nothing, and what an attempt without a commit has left is not read
    (see ``strata.plans.runs``).

    ``partition_by=("source",)`` lays the log out by source, so reading one
    source's state prunes to its folder instead of scanning every source.
    ``buckets=n`` also hashes rows into ``n`` buckets by ``file_name``: a read
    of the log is then already partitioned by file name, so the latest-state
    windows run without shuffling the (ever-growing) log and the join with
    the listing shuffles only the listing. Keep ``n`` fixed for a table.
    Trade-off: all rows of one file name share a bucket, so a file with a
    huge share of the log (e.g. failing on every run for years) is read by
    one task; leave bucketing off when the log can be that skewed (the
    unbucketed plan limits each key per map task before its shuffle).
    """
    run = Run(records.sparkSession, table, run_id or uuid.uuid4().hex)
    if records.isEmpty() or (run_id and run.done() is not None):
        return False
    run.start()
    run.append(records, partition_by, buckets)
    run.commit()
    return True


def compact_log(
    log: DataFrame,
    keys: Sequence[str] = KEYS,
    version_col: str = "source_modified_time",
    time_col: str = "ingestion_time",
    status_col: str = "status",
) -> DataFrame:
    """The rows of ``log`` that any later step can still need: per item its
    latest row and its latest SUCCESS row (at most two rows per item; one
    when they coincide).

    Latest state and latest success each pick a maximum under a total order,
    so compacting ``compact_log(a) U b`` gives the same picks as the whole
    log ``a U b``: a run can work from the compacted log instead of the
    ever-growing history.
    """
    log = with_listed_size(log)
    newest = newest_rows(log, keys, version_col, time_col, status_col)
    return newest.select(*keys, F.inline(F.array_distinct(F.array_compact(F.array("state", "success"))))).select(*log.columns)


def newest_rows(
    log: DataFrame,
    keys: Sequence[str] = KEYS,
    version_col: str = "source_modified_time",
    time_col: str = "ingestion_time",
    status_col: str = "status",
) -> DataFrame:
    """Per item ``state`` and ``success``: its latest row and its latest SUCCESS row (NULL if none) as structs.

    One aggregate with the orders and tie-breakers of ``latest_state`` and
    ``latest_success``. Both maxima combine in each map task before the one
    exchange, so an item holding a third of the log sends a row per task.
    """
    columns = [c for c in log.columns if c not in keys]
    row = F.struct(*columns)
    rest = lambda *used: [c for c in sorted(log.columns) if c not in (*keys, *used)]
    by_time = F.struct(time_col, *rest(time_col))
    by_version = F.struct(version_col, time_col, *rest(version_col, time_col))
    ok = F.col(status_col) == SUCCESS
    return log.groupBy(*keys).agg(
        F.max_by(row, by_time).alias("state"), F.max_by(F.when(ok, row), F.when(ok, by_version)).alias("success")
    )


def incremental_ingest(
    spark: SparkSession,
    inventory: DataFrame,
    landed: DataFrame,
    log_table: str,
    source: str,
    target_dir: str = "",
    now=None,
    *,
    reappeared: bool = False,
    log_buckets: int | None = None,
    state_table: str | None = None,
    state_buckets: int = 256,
    run_id: str | None = None,
) -> DataFrame:
    """Whole incremental step against a log table; returns the action histogram.

    Guards against an empty listing (it would mark everything REMOVED). The
    new records are checkpointed to the shared checkpoint folder before the
    append, so the read of the log and the write to it never interleave and a
    lost executor does not recompute against the already-grown log.

    The run is committed last and in one write (``strata.plans.runs``): a run that
    ends half way is as if it had not been. With a ``run_id`` (of the job run,
    say) it happens once: repeated after its commit it returns the histogram of
    that commit and writes nothing. One writer per log table.

    ``state_table`` keeps a compacted log (``compact_log``) next to the full one,
    in ``state_buckets`` buckets by hash of the file name: each run reads at most
    two rows per item instead of the whole history, and writes only the buckets
    in which it logs something, so its cost follows the listing and the changes,
    not the past runs. The full log is still appended for audit. What runs
    without the state have logged meanwhile is taken over from their rows.
    """
    run = Run(spark, log_table, run_id or uuid.uuid4().hex, source)
    if run_id and (done := run.done()) is not None:
        return done.select(F.explode("actions").alias("action", "n"))
    require_non_empty(inventory, "source inventory")
    state = BucketedState(spark, state_table, log_table, source, state_buckets) if state_table else None
    pending, base = None, read_log(spark, log_table)
    if state and spark.catalog.tableExists(log_table):
        pending = state.pending(visible_rows(spark, log_table))
        kept = [with_listed_size(df).select(*LOG_COLUMNS) for df in (state.rows(state.live()), pending) if df is not None]
        base = reduce(DataFrame.unionByName, kept) if kept else empty_log(spark)
    step = ingest_step(inventory, base, landed, source, target_dir, now, reappeared=reappeared, cut=materialize)
    records = materialize(step.records())
    counts = materialize(step.counts())
    actions = {r.action: r.n for r in counts.collect()}  # a handful of actions
    run.start()
    if not records.isEmpty():
        run.append(records, ("source",), log_buckets)
    if state is None:
        run.commit(actions=actions)
        return counts
    news = records if pending is None else records.unionByName(with_listed_size(pending).select(*LOG_COLUMNS))
    touched = [r.bucket for r in news.select(state.bucket().alias("bucket")).distinct().collect()]  # at most state_buckets
    if touched:
        kept = with_listed_size(base).select(*LOG_COLUMNS).filter(F.col("source") == source)
        of_touched = kept.unionByName(records).filter(state.bucket().isin(touched))
        state.write(compact_log(of_touched), touched, run.attempt)
    run.commit(actions=actions, state=state.table, n_buckets=state.n_buckets, buckets=touched)
    if touched:
        state.vacuum()
    return counts
