"""Manifest log: latest state / success, append, landing records, incremental runs."""

import contextlib
import io
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.plans.manifest import (
    append_records,
    incremental_ingest,
    ingest_step,
    landing_records,
    latest_state,
    latest_success,
    read_log,
)
from strata.schemas import MANIFEST_SCHEMA
from tests.conftest import RUN1, RUN2, T1, T6


def test_manifest_schema_nullability():
    nullable = {f.name: f.nullable for f in MANIFEST_SCHEMA.fields}
    assert nullable == {
        "source": False, "file_name": False, "file_path": False, "file_size": True,
        "source_modified_time": True, "ingestion_time": False, "status": False,
    }


def test_latest_state_is_newest_row(log_rows):
    log = log_rows(
        [
            ("SERIES", "pr.class", "/l/a", 100, T6, RUN1, "SUCCESS"),
            ("SERIES", "pr.class", "/l/a", 100, T6, RUN2, "REMOVED"),
        ]
    )
    assert [r.status for r in latest_state(log).collect()] == ["REMOVED"]


def test_latest_success_newer_version_wins(log_rows):
    log = log_rows(
        [
            ("SERIES", "pr.class", "/l/a", 100, T6, RUN1, "SUCCESS"),
            ("SERIES", "pr.class", "/l/a", 90, T1, RUN2, "SUCCESS"),
        ]
    )
    # Ordered by source version first, so an older version ingested later never wins.
    assert latest_success(log).first().file_size == 100


def test_latest_success_ignores_other_statuses(log_rows):
    log = log_rows(
        [
            ("SERIES", "pr.class", "/l/a", 100, T1, RUN1, "SUCCESS"),
            ("SERIES", "pr.class", "/l/a", 200, T6, RUN2, "FAILED"),
            ("SERIES", "pr.class", "/l/a", 300, T6, RUN2, "REMOVED"),
        ]
    )
    assert [r.file_size for r in latest_success(log).collect()] == [100]


def test_latest_success_null_version_last(log_rows):
    log = log_rows(
        [
            ("POP", "p.json", "/l/p", 100, None, RUN2, "SUCCESS"),
            ("POP", "p.json", "/l/p", 90, T1, RUN1, "SUCCESS"),
        ]
    )
    assert latest_success(log).first().file_size == 90


def test_source_filter(log_rows):
    log = log_rows(
        [
            ("SERIES", "pr.class", "/l/a", 100, T6, RUN1, "SUCCESS"),
            ("POP", "population.json", "/l/p", 5, None, RUN1, "SUCCESS"),
        ]
    )
    assert [r.file_name for r in latest_state(log.filter(F.col("source") == "POP")).collect()] == ["population.json"]


def test_ties_are_deterministic(log_rows):
    # Equal ingestion times -> remaining columns break the tie, same pick every time.
    log = log_rows(
        [
            ("SERIES", "pr.class", "/l/a", 100, T6, RUN1, "SUCCESS"),
            ("SERIES", "pr.class", "/l/a", 100, T6, RUN1, "FAILED"),
        ]
    )
    picks = {latest_state(log.repartition(3)).first().status for _ in range(3)}
    assert len(picks) == 1


def test_empty_append_is_noop(spark):
    name = "log_empty_append"
    assert append_records(spark.createDataFrame([], MANIFEST_SCHEMA), name) is False
    assert not spark.catalog.tableExists(name)


def test_append_allows_null_version(spark):
    name = "log_null_version"
    rows = spark.createDataFrame([("POP", "p.json", "/l/p", 5, None, RUN1, "SUCCESS")], MANIFEST_SCHEMA)
    assert append_records(rows, name) is True
    assert spark.read.table(name).first().source_modified_time is None


def test_landing_records_success_failed_mismatch(spark):
    classified = spark.createDataFrame(
        [("a", 10, "NEW"), ("b", 20, "CHANGED"), ("c", 30, "UNCHANGED"), ("d", 40, "NEW")],
        "file_name string, file_size long, action string",
    )
    landed = spark.createDataFrame([("a", 10), ("b", 25)], "file_name string, length long")
    out = {r.file_name: r for r in landing_records(classified, landed, now=RUN1).collect()}
    assert set(out) == {"a", "b", "d"}
    assert (out["a"].status, out["a"].file_size, out["a"].size_mismatch) == ("SUCCESS", 10, False)
    # Actual size recorded, listed size kept for the next comparison.
    assert (out["b"].status, out["b"].file_size, out["b"].listed_size, out["b"].size_mismatch) == (
        "SUCCESS", 25, 20, True)
    # Failed landing keeps the listed size and does not raise.
    assert (out["d"].status, out["d"].file_size) == ("FAILED", 40)


def _inv(spark, rows):
    return spark.createDataFrame(rows, "file_name string, source_url string, file_size long, source_modified_time timestamp")


def test_incremental_twice_is_idempotent(spark):
    table = "log_incremental"
    inv = _inv(spark, [("pr.a", "u/a", 10, T1), ("pr.b", "u/b", 20, T6)])
    landed = spark.createDataFrame([("pr.a", 10), ("pr.b", 21)], "file_name string, length long")
    first = {r.action: r.n for r in incremental_ingest(spark, inv, landed, table, "SERIES", "/raw", RUN1).collect()}
    assert first == {"NEW": 2}
    second = {r.action: r.n for r in incremental_ingest(spark, inv, landed, table, "SERIES", "/raw", RUN2).collect()}
    # the landed size differed for pr.b, but listed is compared with listed: still UNCHANGED
    assert second == {"UNCHANGED": 2}
    log = read_log(spark, table)
    assert log.count() == 2
    # the log is laid out by source: a per-source read prunes to one folder
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        log.filter(F.col("source") == "SERIES").explain()
    assert "PartitionFilters: [isnotnull(source" in buf.getvalue()
    assert log.filter(F.col("file_name") == "pr.b").first().file_size == 21


def test_failed_item_is_retried(spark):
    table = "log_retry"
    inv = _inv(spark, [("pr.a", "u/a", 10, T1)])
    nothing = spark.createDataFrame([], "file_name string, length long")
    incremental_ingest(spark, inv, nothing, table, "SERIES", now=RUN1)
    again = {r.action: r.n for r in incremental_ingest(spark, inv, nothing, table, "SERIES", now=RUN2).collect()}
    assert again == {"NEW": 1}
    assert [r.status for r in read_log(spark, table).collect()] == ["FAILED", "FAILED"]


def test_removal_then_same_reappearance_stays_removed(spark):
    # T5: a file that reappears unchanged vs its latest SUCCESS is not landed again.
    table = "log_reappear"
    full = _inv(spark, [("pr.a", "u/a", 10, T1), ("pr.b", "u/b", 20, T1)])
    landed = spark.createDataFrame([("pr.a", 10), ("pr.b", 20)], "file_name string, length long")
    incremental_ingest(spark, full, landed, table, "SERIES", now=RUN1)
    incremental_ingest(spark, full.filter(F.col("file_name") == "pr.a"), landed, table, "SERIES", now=RUN2)
    third = {r.action: r.n for r in incremental_ingest(spark, full, landed, table, "SERIES", now=datetime(2026, 9, 1)).collect()}
    assert third == {"UNCHANGED": 2}
    state = {r.file_name: r.status for r in latest_state(read_log(spark, table)).collect()}
    assert state == {"pr.a": "SUCCESS", "pr.b": "REMOVED"}


def test_empty_inventory_is_rejected(spark):
    # An empty listing would mark every file REMOVED.
    with pytest.raises(ValueError):
        incremental_ingest(spark, _inv(spark, []), spark.createDataFrame([], "file_name string, length long"),
                           "log_guard", "SERIES")


def test_ingest_step_is_lazy_and_side_effect_free(spark, log_rows):
    inv = _inv(spark, [("pr.a", "u/a", 10, T1)])
    step = ingest_step(inv, log_rows([]), spark.createDataFrame([("pr.a", 10)], "file_name string, length long"), "SERIES")
    recs = step.records().collect()
    assert [(r.file_name, r.status, r.source) for r in recs] == [("pr.a", "SUCCESS", "SERIES")]


def test_counts_are_fixed_before_the_append(spark):
    # The run's classification is checkpointed before the log grows, so
    # evaluating its counts later never sees the rows this run appended.
    table = "log_lazy"
    inv = _inv(spark, [("pr.a", "u/a", 10, T1)])
    landed = spark.createDataFrame([("pr.a", 10)], "file_name string, length long")
    first = incremental_ingest(spark, inv, landed, table, "SERIES", now=RUN1)
    incremental_ingest(spark, inv, landed, table, "SERIES", now=RUN2)
    assert {r.action: r.n for r in first.collect()} == {"NEW": 1}


def test_reappeared_is_opt_in(spark):
    # T5 fix, opt-in: the file that came back is labelled REAPPEARED and landed, state returns to SUCCESS.
    table = "log_reappear_opt_in"
    full = _inv(spark, [("pr.a", "u/a", 10, T1), ("pr.b", "u/b", 20, T1)])
    landed = spark.createDataFrame([("pr.a", 10), ("pr.b", 20)], "file_name string, length long")
    incremental_ingest(spark, full, landed, table, "SERIES", now=RUN1, reappeared=True)
    incremental_ingest(spark, full.filter(F.col("file_name") == "pr.a"), landed, table, "SERIES", now=RUN2,
                       reappeared=True)
    third = incremental_ingest(spark, full, landed, table, "SERIES", now=datetime(2026, 9, 1), reappeared=True)
    assert {r.action: r.n for r in third.collect()} == {"UNCHANGED": 1, "REAPPEARED": 1}
    state = {r.file_name: r.status for r in latest_state(read_log(spark, table)).collect()}
    assert state == {"pr.a": "SUCCESS", "pr.b": "SUCCESS"}


def test_bucketed_log_needs_no_shuffle_for_state(spark):
    table = "log_bucketed"
    inv = _inv(spark, [("pr.a", "u/a", 10, T1), ("pr.b", "u/b", 20, T6)])
    landed = spark.createDataFrame([("pr.a", 10), ("pr.b", 20)], "file_name string, length long")
    incremental_ingest(spark, inv, landed, table, "SERIES", now=RUN1, log_buckets=4)
    again = incremental_ingest(spark, inv, landed, table, "SERIES", now=RUN2, log_buckets=4)
    assert {r.action: r.n for r in again.collect()} == {"UNCHANGED": 2}
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        latest_state(read_log(spark, table), ["file_name"]).explain()
    assert "Exchange" not in buf.getvalue() and "Bucketed: true" in buf.getvalue()


def test_table_readers_filter_one_source(spark):
    from strata.plans.manifest import table_latest_state, table_latest_success

    table = "log_two_sources"
    rows = spark.createDataFrame(
        [
            ("SERIES", "pr.a", "/l/a", 10, T1, RUN1, "SUCCESS"),
            ("SERIES", "pr.a", "/l/a", 10, T1, RUN2, "REMOVED"),
            ("POP", "p.json", "/l/p", 5, None, RUN1, "SUCCESS"),
        ],
        MANIFEST_SCHEMA,
    )
    append_records(rows, table, partition_by=("source",))
    assert [(r.file_name, r.status) for r in table_latest_state(spark, table, "SERIES").collect()] == [("pr.a", "REMOVED")]
    assert [(r.file_name, r.status) for r in table_latest_success(spark, table, "SERIES").collect()] == [("pr.a", "SUCCESS")]
    assert [r.file_name for r in table_latest_state(spark, table, "POP").collect()] == ["p.json"]


def test_compacted_state_gives_the_same_runs(spark):
    # a run over the compacted log must classify exactly like a run over the whole log
    from strata.plans.manifest import compact_log

    a = ("pr.a", "u/a", 10, T1)
    runs = [
        ([a, ("pr.b", "u/b", 20, T1), ("pr.c", "u/c", 30, T1)], ["pr.a", "pr.b"]),  # pr.c fails to land
        ([("pr.a", "u/a", 11, T6), ("pr.c", "u/c", 30, T1)], ["pr.a", "pr.c"]),  # a changed, b removed, c retried
        ([("pr.a", "u/a", 11, T6), ("pr.b", "u/b", 20, T1), ("pr.c", "u/c", 30, T1)], ["pr.a", "pr.b", "pr.c"]),
        ([("pr.a", "u/a", 11, T6)], ["pr.a"]),
    ]
    results = {}
    for mode in ("full", "compact", "late"):  # late: the state table starts after two runs (built from the log)
        table = f"log_{mode}"
        out = []
        for i, (inv_rows, landed_names) in enumerate(runs):
            inv = _inv(spark, inv_rows)
            sizes = {r[0]: r[2] for r in inv_rows}
            landed = spark.createDataFrame([(n, sizes[n]) for n in landed_names], "file_name string, length long")
            use_state = mode == "compact" or (mode == "late" and i >= 2)
            kwargs = {"state_table": f"state_{mode}"} if use_state else {}
            counts = incremental_ingest(spark, inv, landed, table, "SERIES", now=datetime(2026, 9, 1 + i), **kwargs)
            out.append({r.action: r.n for r in counts.collect()})
        results[mode] = out
    assert results["compact"] == results["full"]
    assert results["late"] == results["full"]
    full_state = {r.file_name: r.status for r in latest_state(read_log(spark, "log_full")).collect()}
    compact_state = {r.file_name: r.status for r in latest_state(spark.read.table("state_compact")).collect()}
    assert compact_state == full_state
    assert spark.read.table("state_compact").count() <= 2 * 3
    assert read_log(spark, "log_compact").count() == read_log(spark, "log_full").count()
    # compaction is idempotent on the picks
    log = read_log(spark, "log_full")
    twice = compact_log(compact_log(log))
    assert {r.file_name: r.status for r in latest_state(twice).collect()} == full_state


def test_window_over_union_of_windowed_frames(spark):
    # needs spark.sql.unionOutputPartitioning=false, which strata.session sets
    table = "log_union_shape"
    inv = _inv(spark, [("pr.a", "u/a", 10, T1), ("pr.b", "u/b", 20, T1), ("pr.c", "u/c", 30, T1)])
    landed = spark.createDataFrame([("pr.a", 10), ("pr.b", 20)], "file_name string, length long")
    incremental_ingest(spark, inv, landed, table, "SERIES", now=RUN1)
    incremental_ingest(spark, inv.filter(F.col("file_name") != "pr.b"), landed, table, "SERIES", now=RUN2)
    log = read_log(spark, table)
    union_once = latest_state(log).unionByName(latest_success(log))
    union_twice = latest_state(union_once).unionByName(latest_success(union_once))
    assert latest_state(union_twice).count() == 3


def _landed(spark, rows):
    return spark.createDataFrame(rows, "file_name string, length long, modification_time timestamp")


def test_an_old_copy_of_a_changed_file_is_failed_and_retried(spark):
    table = "log_stale"
    day = lambda n: datetime(2026, 9, n)
    actions = lambda counts: {r.action: r.n for r in counts.collect()}
    last = lambda: latest_state(read_log(spark, table)).first()
    old, new = _inv(spark, [("pr.a", "u/a", 10, T1)]), _inv(spark, [("pr.a", "u/a", 11, T6)])
    assert actions(incremental_ingest(spark, old, _landed(spark, [("pr.a", 10, T1)]), table, "SERIES", now=day(1))) == {"NEW": 1}
    assert last().status == "SUCCESS"
    # run 2: the listing changed, the folder still holds the first copy
    assert actions(incremental_ingest(spark, new, _landed(spark, [("pr.a", 10, T1)]), table, "SERIES", now=day(2))) == {"CHANGED": 1}
    assert (last().status, last().file_size) == ("FAILED", 11)
    # run 3: it is CHANGED again, and its new copy has landed
    assert actions(incremental_ingest(spark, new, _landed(spark, [("pr.a", 11, day(3))]), table, "SERIES", now=day(3))) == {"CHANGED": 1}
    assert last().status == "SUCCESS"
    assert actions(incremental_ingest(spark, new, _landed(spark, [("pr.a", 11, day(3))]), table, "SERIES", now=day(4))) == {"UNCHANGED": 1}


def test_same_time_change_needs_a_copy_newer_than_the_last_success(spark):
    table = "log_stale_same_time"
    copy = _landed(spark, [("pr.a", 10, T6)])
    incremental_ingest(spark, _inv(spark, [("pr.a", "u/a", 10, T1)]), copy, table, "SERIES", now=datetime(2026, 9, 1))
    incremental_ingest(spark, _inv(spark, [("pr.a", "u/a", 12, T1)]), copy, table, "SERIES", now=datetime(2026, 9, 2))
    assert latest_state(read_log(spark, table)).first().status == "FAILED"


def test_a_state_table_that_lags_is_rebuilt(spark):
    # run with state, without, with: the third sees what the second logged
    table, state = "log_mixed", "state_mixed"
    old, new = _inv(spark, [("pr.a", "u/a", 10, T1)]), _inv(spark, [("pr.a", "u/a", 11, T6)])
    landed = lambda n: spark.createDataFrame([("pr.a", n)], "file_name string, length long")
    incremental_ingest(spark, old, landed(10), table, "SERIES", now=datetime(2026, 9, 1), state_table=state)
    incremental_ingest(spark, new, landed(11), table, "SERIES", now=datetime(2026, 9, 2))
    third = incremental_ingest(spark, new, landed(11), table, "SERIES", now=datetime(2026, 9, 3), state_table=state)
    assert {r.action: r.n for r in third.collect()} == {"UNCHANGED": 1}
