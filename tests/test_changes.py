"""Change classification and removal detection (cases of the reference's tests + traps T4, T6)."""

from pyspark.sql import functions as F

from strata.operators.changes import action_counts, classify_changes, classify_content, detect_removed
from strata.plans.manifest import latest_state, latest_success, removed_records
from tests.conftest import RUN1, RUN2, T1, T6

URL = "https://x.org/pub/pr.class"


def _classify(inv, log):
    prev = latest_success(log).select("file_name", "file_size", "source_modified_time")
    return classify_changes(inv, prev, ["file_name"], ["file_size", "source_modified_time"])


def _action(df):
    return [r.action for r in df.select("action").collect()]


def test_new_when_not_in_log(spark, inventory, log_rows):
    inv = inventory([("pr.class", URL, 100, T6)])
    assert _action(_classify(inv, log_rows([]))) == ["NEW"]


def test_unchanged_when_same(spark, inventory, log_rows):
    inv = inventory([("pr.class", URL, 100, T6)])
    log = log_rows([("SERIES", "pr.class", "/l/pr.class", 100, T6, RUN1, "SUCCESS")])
    assert _action(_classify(inv, log)) == ["UNCHANGED"]


def test_changed_by_size(spark, inventory, log_rows):
    inv = inventory([("pr.class", URL, 200, T6)])
    log = log_rows([("SERIES", "pr.class", "/l/pr.class", 100, T6, RUN1, "SUCCESS")])
    assert _action(_classify(inv, log)) == ["CHANGED"]


def test_changed_by_time(spark, inventory, log_rows):
    inv = inventory([("pr.class", URL, 100, T6)])
    log = log_rows([("SERIES", "pr.class", "/l/pr.class", 100, T1, RUN1, "SUCCESS")])
    assert _action(_classify(inv, log)) == ["CHANGED"]


def test_compares_with_latest_success_only(spark, inventory, log_rows):
    inv = inventory([("pr.class", URL, 100, T6)])
    log = log_rows(
        [
            ("SERIES", "pr.class", "/l/pr.class", 100, T6, RUN1, "SUCCESS"),
            ("SERIES", "pr.class", "/l/pr.class", 300, T6, RUN2, "FAILED"),
        ]
    )
    assert _action(_classify(inv, log)) == ["UNCHANGED"]


def test_null_time_is_unchanged_unless_null_safe(spark, inventory, log_rows):
    # T4: a NULL comparison is not TRUE, so the three-valued test says UNCHANGED.
    inv = inventory([("pr.class", URL, 100, T6)])
    log = log_rows([("SERIES", "pr.class", "/l/pr.class", 100, None, RUN1, "SUCCESS")])
    assert _action(_classify(inv, log)) == ["UNCHANGED"]
    prev = latest_success(log).select("file_name", "file_size", "source_modified_time")
    strict = classify_changes(inv, prev, ["file_name"], ["file_size", "source_modified_time"], null_safe=True)
    assert _action(strict) == ["CHANGED"]


def test_null_time_but_size_differs_is_changed(spark, inventory, log_rows):
    inv = inventory([("pr.class", URL, 200, T6)])
    log = log_rows([("SERIES", "pr.class", "/l/pr.class", 100, None, RUN1, "SUCCESS")])
    assert _action(_classify(inv, log)) == ["CHANGED"]


def test_removed_when_gone(spark, inventory, log_rows):
    inv = inventory([("pr.other", URL, 1, T6)])
    log = log_rows([("SERIES", "pr.class", "/l/pr.class", 100, T6, RUN1, "SUCCESS")])
    removed = detect_removed(latest_state(log), inv, ["file_name"])
    assert [r.file_name for r in removed.collect()] == ["pr.class"]


def test_already_removed_is_not_repeated(spark, inventory, log_rows):
    inv = inventory([("pr.other", URL, 1, T6)])
    log = log_rows(
        [
            ("SERIES", "pr.class", "/l/pr.class", 100, T6, RUN1, "SUCCESS"),
            ("SERIES", "pr.class", "/l/pr.class", 100, T6, RUN2, "REMOVED"),
        ]
    )
    assert detect_removed(latest_state(log), inv, ["file_name"]).count() == 0


def test_failed_item_is_never_removed(spark, inventory, log_rows):
    # Only keys whose latest state is SUCCESS can be removed.
    inv = inventory([("pr.other", URL, 1, T6)])
    log = log_rows(
        [
            ("SERIES", "pr.class", "/l/pr.class", 100, T6, RUN1, "SUCCESS"),
            ("SERIES", "pr.class", "/l/pr.class", 100, T6, RUN2, "FAILED"),
        ]
    )
    assert detect_removed(latest_state(log), inv, ["file_name"]).count() == 0


def test_removed_record_shape(spark, log_rows):
    log = log_rows([("SERIES", "pr.class", "/l/pr.class", 100, T6, RUN1, "SUCCESS")])
    rec = removed_records(log, RUN2).collect()[0]
    assert (rec.source, rec.file_name, rec.file_path, rec.file_size) == ("SERIES", "pr.class", "/l/pr.class", 100)
    assert rec.source_modified_time == T6 and rec.ingestion_time == RUN2 and rec.status == "REMOVED"


def test_content_new_unchanged_changed(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, body string")
    prev = spark.createDataFrame([(2, "b"), (3, "C")], "id long, body string")
    out = {r.id: r.action for r in classify_content(cur, prev, ["id"], "body").collect()}
    assert out == {1: "NEW", 2: "UNCHANGED", 3: "CHANGED"}


def test_content_on_binary(spark):
    cur = spark.createDataFrame([(1, bytearray(b"\x00\x01")), (2, bytearray(b"x"))], "id long, content binary")
    prev = spark.createDataFrame([(1, bytearray(b"\x00\x01")), (2, bytearray(b"y"))], "id long, content binary")
    out = {r.id: r.action for r in classify_content(cur, prev, ["id"], "content").collect()}
    assert out == {1: "UNCHANGED", 2: "CHANGED"}


def test_action_counts(spark):
    df = spark.createDataFrame([("NEW",), ("NEW",), ("CHANGED",)], "action string")
    assert {r.action: r.n for r in action_counts(df).collect()} == {"NEW": 2, "CHANGED": 1}


def test_multi_key_classification(spark):
    cur = spark.createDataFrame([("A", "f", 1), ("B", "f", 2)], "src string, name string, sz long")
    prev = spark.createDataFrame([("A", "f", 1)], "src string, name string, sz long")
    out = classify_changes(cur, prev, ["src", "name"], ["sz"]).orderBy("src")
    assert _action(out) == ["UNCHANGED", "NEW"]
    assert out.filter(F.col("src") == "A").first().prev_sz == 1


def test_content_records_only_for_new_or_changed(spark):
    from strata.plans.manifest import content_records

    cur = spark.createDataFrame([("p.json", "/l/p.json", "abc")], "file_name string, file_path string, body string")
    prev_same = spark.createDataFrame([("p.json", "abc")], "file_name string, body string")
    prev_diff = spark.createDataFrame([("p.json", "abd")], "file_name string, body string")
    for prev, n in ((prev_same, 0), (prev_diff, 1)):
        sized = cur.withColumn("file_size", F.octet_length("body"))
        classified = classify_content(sized, prev, ["file_name"], "body")
        assert "body" not in classified.columns  # contents stay out of the join
        recs = content_records(classified, "POPULATION", now=RUN1).collect()
        assert len(recs) == n
    assert recs[0].source_modified_time is None and recs[0].status == "SUCCESS" and recs[0].file_size == 3
