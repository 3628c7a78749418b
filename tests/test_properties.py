"""Property tests: operators against plain-Python brute force on random inputs,
and a hot-key case where one key holds a third of all rows."""

from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.analytics import best_period
from strata.operators.changes import classify_changes, detect_removed
from strata.operators.latest import latest_by_key
from strata.operators.quality import quality_gate, quality_report

SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.integers(0, 12)
sizes = st.one_of(st.none(), st.integers(0, 3))


@SETTINGS
@given(
    cur=st.dictionaries(keys, st.tuples(sizes, sizes), max_size=10),
    prev=st.dictionaries(keys, st.tuples(sizes, sizes), max_size=10),
)
def test_classify_changes_matches_brute_force(spark, cur, prev):
    cur_df = spark.createDataFrame([(k, a, b) for k, (a, b) in cur.items()], "k int, a int, b int")
    prev_df = spark.createDataFrame([(k, a, b) for k, (a, b) in prev.items()], "k int, a int, b int")
    got = {r.k: r.action for r in classify_changes(cur_df, prev_df, ["k"], ["a", "b"]).collect()}

    def differs(x, y):  # SQL three-valued "<>"
        return None if x is None or y is None else x != y

    def sql_or(p, q):
        if p is True or q is True:
            return True
        return None if p is None or q is None else False

    want = {}
    for k, (a, b) in cur.items():
        if k not in prev:
            want[k] = "NEW"
        else:
            pa, pb = prev[k]
            want[k] = "CHANGED" if sql_or(differs(a, pa), differs(b, pb)) is True else "UNCHANGED"
    assert got == want

    state = spark.createDataFrame([(k, "SUCCESS") for k in prev], "k int, status string")
    removed = {r.k for r in detect_removed(state, cur_df, ["k"]).collect()}
    assert removed == set(prev) - set(cur)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 5))), max_size=30))
def test_latest_by_key_matches_brute_force(spark, rows):
    data = [(k, t, i) for i, (k, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, t int, id int").repartition(3)
    got = {r.k: r.id for r in latest_by_key(df, ["k"], [F.col("t").desc_nulls_last(), F.col("id").desc()]).collect()}
    best = {}
    for k, t, i in data:
        rank = (t is not None, t if t is not None else 0, i)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, i)
    assert got == {k: v[1] for k, v in best.items()}


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(st.integers(0, 3), st.integers(2000, 2004), st.decimals(-5, 5, places=2, allow_nan=False)),
        max_size=30,
    )
)
def test_best_period_matches_brute_force(spark, rows):
    data = [(s, y, float(v)) for s, y, v in rows]
    df = spark.createDataFrame(data, "s int, y int, v double").repartition(4)
    got = {(r.s, r.y): r.latest for r in best_period(df, "s", "y", "v", exact=True, period_col="y",
                                                      sum_col="total", flag_col="latest").collect()}
    sums = defaultdict(Decimal)
    for s, y, v in rows:
        sums[(s, y)] += v
    want = {}
    for s in {s for s, _ in sums}:
        top = max(v for (s2, _), v in sums.items() if s2 == s)
        years = sorted(y for (s2, y), v in sums.items() if s2 == s and v == top)
        want.update({(s, y): y == years[-1] for y in years})
    assert got == want


RULES = {"positive": "v > 0", "small": "v < 3"}


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(-2, 5)), max_size=20))
def test_quality_gate_partitions_rows(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v int")
    kept, rejected = quality_gate(df, RULES)
    ok = {i for i, v in enumerate(vals) if v is not None and 0 < v < 3}
    assert {r.id for r in kept.collect()} == ok
    assert {r.id for r in rejected.collect()} == set(range(len(vals))) - ok
    report = {r.rule: (r.n_rows, r.n_failed) for r in quality_report(df, RULES).collect()}
    assert report["positive"] == (len(vals), sum(1 for v in vals if v is None or v <= 0))
    assert report["small"] == (len(vals), sum(1 for v in vals if v is None or v >= 3))


def test_hot_key_third_of_rows(spark):
    """One key holds a third of the rows: results stay exact and whole, and the
    per-task group limit keeps the shuffle to one row per key per task."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("t"),
    ).repartition(8)
    latest = latest_by_key(df, ["k"], [F.col("t").desc()])
    assert latest.count() == n - n // 3 + 1
    assert latest.filter(F.col("k") == -1).first().t == n - 3
    sums = best_period(df.withColumn("v", F.lit(1.0)), "k", F.col("t") % 2, "v", exact=True,
                       period_col="p", sum_col="s", flag_col="f")
    hot = sorted((r.p, r.s) for r in sums.filter(F.col("k") == -1).collect())
    assert hot == [(0, 5000.0), (1, 5000.0)]


@SETTINGS
@given(texts=st.lists(st.one_of(st.none(), st.sampled_from(["a", "bb", "a b", "", "é"])), max_size=25))
def test_duplicate_keys_digest_equals_plain(spark, texts):
    from strata.operators.quality import duplicate_keys

    df = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = sorted((r.text or "<null>", r.n) for r in duplicate_keys(df, ["text"]).collect())
    fast = sorted((r.text or "<null>", r.n) for r in duplicate_keys(df, ["text"], digest=True).collect())
    assert fast == plain


entry = st.tuples(
    st.dates(min_value=__import__("datetime").date(1990, 1, 1), max_value=__import__("datetime").date(2030, 12, 31)),
    st.integers(0, 23),
    st.integers(0, 59),
    st.integers(0, 10**9),
    st.from_regex(r"[a-zA-Z0-9_]{1,12}(\.[a-zA-Z0-9]{1,5})?", fullmatch=True),
    st.booleans(),
    st.booleans(),
)


@SETTINGS
@given(entries=st.lists(entry, min_size=1, max_size=6), noise=st.booleans())
def test_parse_listing_round_trip(spark, entries, noise):
    from datetime import datetime

    from strata.sources.listing import parse_listing

    lines, want = [], []
    for day, hour, minute, size, stem, upper, absolute in entries:
        h12 = hour % 12 or 12
        ampm = ("AM" if hour < 12 else "PM") if upper else ("am" if hour < 12 else "pm")
        name = f"pr.{stem}"
        href = f"/pub/x/{name}" if absolute else name
        tag = f'<A HREF="{href}">{name}</A>' if upper else f'<a href="{href}">{name}</a>'
        lines.append(f" {day.month}/{day.day}/{day.year}  {h12}:{minute:02d} {ampm}   {size} {tag}<br>")
        if noise:
            lines.append(f" {day.month}/{day.day}/{day.year} {h12}:{minute:02d} {ampm} {size} <A HREF=\"/r\">readme</A><br>")
        want.append((name, f"https://h.org/pub/x/{name}", size, datetime(day.year, day.month, day.day, hour, minute)))
    pages = spark.createDataFrame([("\n".join(lines),)], "html string")
    got = [(r.file_name, r.source_url, r.file_size, r.source_modified_time)
           for r in parse_listing(pages, "html", "https://h.org/pub/x/").collect()]
    assert got == want


cell = st.from_regex(r"[a-z0-9 .\-]{0,6}", fullmatch=True)


@SETTINGS
@given(rows=st.lists(st.lists(cell, min_size=1, max_size=4), min_size=1, max_size=12))
def test_parse_delimited_matches_split(spark, rows):
    # T1 semantics: fields bind by position, blanks inside cells are kept,
    # an empty cell or a missing trailing field is NULL, extra fields are dropped.
    from pyspark.sql.types import StringType, StructField, StructType

    from strata.sources.delimited import parse_delimited

    schema = StructType([StructField(f"c{i}", StringType()) for i in range(3)])
    lines = ["\t".join(r) for r in rows]
    got = [tuple(r) for r in parse_delimited(spark.createDataFrame([(x,) for x in lines], "line string"),
                                             "line", schema).collect()]
    want = []
    for r in rows:
        fields = (list(r) + [None, None, None])[:3]
        want.append(tuple(None if f == "" else f for f in fields))
    assert got == want


@SETTINGS
@given(
    facts=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 100)), max_size=20),
    dim=st.dictionaries(st.integers(0, 8), st.sampled_from(["a", "b", None]), max_size=6),
)
def test_enrich_is_a_left_join(spark, facts, dim):
    from strata.operators.enrich import DimSpec, enrich

    fact_df = spark.createDataFrame([(k, v) for k, v in facts], "k int, v int")
    dim_df = spark.createDataFrame([(k, n) for k, n in dim.items()], "dk int, name string")
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        out = enrich(fact_df, [DimSpec(dim_df, "k", "dk", ["name"])])
        got = sorted((r.k, r.v, r.name or "") for r in out.collect())
        assert got == sorted((k, v, dim.get(k) or "") for k, v in facts)


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.text(max_size=3),
    lambda inner: st.lists(inner, max_size=2) | st.dictionaries(st.text(max_size=2), inner, max_size=2),
    max_leaves=4,
)


@SETTINGS
@given(docs=st.lists(st.one_of(json_values.map(__import__("json").dumps), st.just("{oops")), max_size=10))
def test_missing_json_keys_matches_python(spark, docs):
    import json

    from strata.operators.quality import missing_json_keys

    df = spark.createDataFrame(list(enumerate(docs)), "id int, js string")
    got = {r.id: sorted(r.missing_keys) for r in missing_json_keys(df, "js", ["a", "b"]).collect()}
    want = {}
    for i, d in enumerate(docs):
        try:
            obj = json.loads(d)
        except ValueError:
            obj = None
        keys = set(obj) if isinstance(obj, dict) else set()
        miss = sorted(k for k in ("a", "b") if k not in keys)
        if miss:
            want[i] = miss
    assert got == want


@SETTINGS
@given(rows=st.lists(st.lists(cell, min_size=1, max_size=4), min_size=1, max_size=12))
def test_unquoted_split_equals_csv_parser(spark, rows):
    from pyspark.sql.types import StringType, StructField, StructType

    from strata.sources.delimited import parse_delimited

    schema = StructType([StructField(f"c{i}", StringType()) for i in range(3)])
    df = spark.createDataFrame([("\t".join(r),) for r in rows] + [(None,)], "line string")
    csv = [tuple(r) for r in parse_delimited(df, "line", schema).collect()]
    fast = [tuple(r) for r in parse_delimited(df, "line", schema, quoting=False).collect()]
    assert fast == csv
