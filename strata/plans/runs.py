"""Committed runs of an append-only log, and a state that is kept by buckets.

A run first notes that it starts, then appends its rows, marked with an attempt
of its own, and notes its commit last. Rows of an attempt without a commit are
not part of the log, so a run that ends half way leaves nothing behind, and a
run that is repeated under the same id after its commit does nothing.

The state of a log holds what later runs can still need (``compact_log``), in
buckets by hash of the file name. A run writes new versions of those buckets
only in which something changed; its commit names them, so log and state become
visible together. Runs that did not keep the state are read from the log by the
next run that does: no run compares times or reads the log as a whole.

One writer a log, as for any plain table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STARTED, COMMITTED = "STARTED", "COMMITTED"
#: Columns that mark the rows of a run in the log table.
RUN_COLUMNS = ("run_id", "attempt")
RUNS = (
    "source string, run_id string, attempt string, phase string, seq long, actions map<string, bigint>, "
    "state string, n_buckets int, buckets array<int>"
)


def runs_table(log_table: str) -> str:
    return f"{log_table}_runs"


def read_runs(spark: SparkSession, log_table: str) -> DataFrame:
    """Two rows a run: started and committed."""
    if spark.catalog.tableExists(runs_table(log_table)):
        return spark.read.table(runs_table(log_table))
    return spark.createDataFrame([], RUNS)


def committed(spark: SparkSession, log_table: str, source: str | None = None) -> DataFrame:
    """Commit rows, of one source and of appends that name none."""
    done = read_runs(spark, log_table).filter(F.col("phase") == COMMITTED)
    return done if source is None else done.filter(F.col("source").isNull() | (F.col("source") == source))


def open_attempts(spark: SparkSession, log_table: str) -> list[str]:
    """Attempts that started and did not commit (as many as runs have failed)."""
    phases = read_runs(spark, log_table).groupBy("attempt").agg(F.max(F.col("phase") == COMMITTED).alias("done"))
    return [r.attempt for r in phases.filter(~F.col("done")).select("attempt").collect()]


def visible_rows(spark: SparkSession, log_table: str) -> DataFrame:
    """The log's rows of committed runs, with their run columns."""
    log = spark.read.table(log_table)
    if "attempt" not in log.columns:
        return log.withColumns({c: F.lit(None).cast("string") for c in RUN_COLUMNS})
    left = open_attempts(spark, log_table)
    return log.filter(F.col("attempt").isNull() | ~F.col("attempt").isin(left)) if left else log


@dataclass
class Run:
    """One attempt at a run; use ``start``, ``append``, then ``commit``."""

    spark: SparkSession
    log_table: str
    run_id: str
    source: str | None = None
    attempt: str = field(default_factory=lambda: uuid.uuid4().hex)

    def done(self) -> DataFrame | None:
        """The commit row of an earlier attempt at this run, if it has committed."""
        mine = committed(self.spark, self.log_table).filter((F.col("run_id") == self.run_id) & F.col("source").eqNullSafe(F.lit(self.source)))
        return None if mine.isEmpty() else mine

    def _note(self, phase: str, **values) -> None:
        row = {"source": self.source, "run_id": self.run_id, "attempt": self.attempt, "phase": phase} | values
        names = [f.split()[0] for f in RUNS.replace("map<string, bigint>", "map").split(", ")]
        frame = self.spark.createDataFrame([tuple(row.get(n) for n in names)], RUNS)
        frame.coalesce(1).write.mode("append").format("parquet").saveAsTable(runs_table(self.log_table))

    def start(self) -> None:
        self._note(STARTED)

    def append(self, rows: DataFrame, partition_by: Sequence[str] = (), buckets: int | None = None) -> None:
        """Append rows under this attempt; nothing reads them before the commit."""
        spark, table = self.spark, self.log_table
        if spark.catalog.tableExists(table) and "attempt" not in spark.read.table(table).columns:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS (run_id STRING, attempt STRING)")
        marked = rows.withColumns({"run_id": F.lit(self.run_id), "attempt": F.lit(self.attempt)})
        writer = marked.write.mode("append").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if buckets:
            writer = writer.bucketBy(buckets, "file_name").sortBy("file_name")
        writer.saveAsTable(table)

    def commit(self, **values) -> None:
        """Make the attempt's rows (and the state buckets that ``values`` name) part of the log: one row, one file."""
        last = committed(self.spark, self.log_table).agg(F.max("seq")).first()[0]
        self._note(COMMITTED, seq=(last or 0) + 1, **values)


# ------------------------------------------------------------------ the state
@dataclass
class BucketedState:
    """The compacted log of one source in a table partitioned by source, bucket and attempt."""

    spark: SparkSession
    table: str
    log_table: str
    source: str
    n_buckets: int

    def __post_init__(self) -> None:
        if self.exists() and "attempt" not in self.spark.read.table(self.table).columns:
            raise ValueError(f"{self.table} is no bucketed state; drop it, the next run builds it from the log")
        others = self._commits().filter(F.col("n_buckets") != self.n_buckets).select("n_buckets").limit(1).collect()
        if others:
            raise ValueError(f"{self.table} has {others[0][0]} buckets, not {self.n_buckets}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def _commits(self) -> DataFrame:
        return committed(self.spark, self.log_table, self.source).filter(F.col("state") == self.table)

    def bucket(self):
        return F.pmod(F.xxhash64("file_name"), F.lit(self.n_buckets)).cast("int")

    def live(self) -> dict[int, str]:
        """Per bucket the attempt that wrote its newest committed version (at most ``n_buckets`` entries)."""
        if not self.exists():
            return {}
        versions = self._commits().select("attempt", "seq", F.explode("buckets").alias("bucket"))
        return {r.bucket: r.attempt for r in versions.groupBy("bucket").agg(F.max_by("attempt", "seq").alias("attempt")).collect()}

    def rows(self, live: dict[int, str]) -> DataFrame | None:
        """The newest committed version of every bucket; whole folders of older ones are passed by."""
        if not live:
            return None
        state = self.spark.read.table(self.table).filter((F.col("source") == self.source) & F.col("attempt").isin(sorted(set(live.values()))))
        pairs = self.spark.createDataFrame([(b, a) for b, a in live.items()], "bucket int, attempt string")
        return state.join(F.broadcast(pairs), ["bucket", "attempt"], "left_semi").drop("bucket", "attempt")

    def pending(self, log: DataFrame) -> DataFrame | None:
        """Rows of ``log`` (``visible_rows``) that the state does not hold yet; None if there are none.

        Every run that keeps the state takes over all commits before its own, so
        these are the rows of later commits; without a state, all rows.
        """
        log = log.filter(F.col("source") == self.source)
        last = self._commits().agg(F.max("seq")).first()[0]
        if last is None or not self.exists():
            return log
        later = committed(self.spark, self.log_table, self.source).filter(F.col("seq") > last).select("attempt").collect()
        return log.filter(F.col("attempt").isin([r.attempt for r in later])) if later else None

    def write(self, rows: DataFrame, touched: list[int], attempt: str) -> None:
        """New versions of the ``touched`` buckets; unseen before the commit that names them.

        Buckets are parted by file name into about as many tasks as a shuffle has, so
        few large buckets keep all cores busy; each task writes a file.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(F.xxhash64("file_name", F.lit(11)), F.lit(max(1, tasks // len(touched))))
        out = rows.withColumn("bucket", self.bucket()).filter(F.col("bucket").isin(touched)).withColumn("attempt", F.lit(attempt))
        out.repartition("bucket", part).write.mode("append").format("parquet").partitionBy("source", "bucket", "attempt").saveAsTable(self.table)

    def vacuum(self) -> None:
        """Drop versions that no commit keeps live. Only the one writer reads the state, so none is in use."""
        live = {(str(b), a) for b, a in self.live().items()}
        own = self.source.replace("\\", "\\\\").replace("'", "\\'")
        shown = self.spark.sql(f"SHOW PARTITIONS {self.table} PARTITION (source = '{own}')").collect()
        parts = [dict(p.split("=", 1) for p in r[0].split("/")) for r in shown]
        dead = [p for p in parts if (p["bucket"], p["attempt"]) not in live]
        if dead:
            named = ", ".join(f"PARTITION (source = '{own}', bucket = {p['bucket']}, attempt = '{p['attempt']}')" for p in dead)
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {named}")
