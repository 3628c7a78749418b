"""Physical-plan checks: the shapes that decide behaviour at scale."""

import contextlib
import io

import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(contract.core_queries()))
def test_no_python_udf_cartesian_or_nested_loop(spark, name):
    p = plan(contract.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"


def test_best_year_plan(spark):
    p = plan(contract.q_best_year_by_series(spark, SF))
    # partial sum before the shuffle, one exchange on (cust, year) and one on cust only
    assert "partial_sum" in p
    assert p.count("Exchange hashpartitioning(o_custkey") == 2
    # the rank filter is applied per task before the shuffle
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "PushedFilters: [In(o_orderstatus, [F,O])]" in p
    assert "o_orderpriority" not in p  # unused columns are not read


def _line_of(lines, *needles):
    return next(i for i, line in enumerate(lines) if all(n in line for n in needles))


@pytest.mark.parametrize("name", ["latest_state", "latest_success", "top_with_ties", "change_actions"])
def test_rank_filter_limits_before_shuffle(spark, name):
    # the plan prints parents first: the Partial limit must sit below (run before) the exchange
    lines = plan(contract.queries()[name](spark, SF)).splitlines()
    final = _line_of(lines, "WindowGroupLimit", "Final")
    exchange = _line_of(lines[final:], "Exchange hashpartitioning") + final
    partial = _line_of(lines[exchange:], "WindowGroupLimit", "Partial") + exchange
    assert final < exchange < partial


def test_row_local_queries_do_not_shuffle(spark):
    for q in (contract.q_extract_links, contract.q_listing_inventory, contract.q_explode_records,
              contract.q_read_delimited, contract.q_typed_clean, contract.q_quality_gate):
        assert "Exchange" not in plan(q(spark, SF)), q.__name__


def test_quality_report_single_scan(spark):
    p = plan(contract.q_quality_report(spark, SF))
    assert p.count("FileScan") == 1


def test_content_hash_before_join(spark):
    p = plan(contract.q_content_changes(spark, SF))
    # both sides are hashed below the join, so only digests cross the exchange
    join = p.index("Join")
    assert p.count("sha2(") >= 2 and p.rindex("sha2(") > join


def test_series_filter_reaches_scan(spark):
    p = plan(contract.q_series_with_context(spark, SF))
    assert "EqualTo(l_returnflag,N)" in p
    # a range of years is a range of dates that the scan can prune by
    for q in (contract.q_series_with_context, contract.q_range_mean_stddev):
        p = plan(q(spark, SF))
        assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_preview_is_top_k(spark):
    assert "TakeOrderedAndProject" in plan(contract.q_preview(spark, SF))


@pytest.mark.parametrize("name,fn", [("raw_observations_best_year", "from_csv("), ("read_delimited", "from_csv("),
                                     ("explode_records", "from_json("), ("extract_links", "regexp_extract_all(regexp_replace(html")])
def test_parsers_run_once_per_row(spark, name, fn):
    # predicate pushdown / inferred filters must not re-evaluate a parser per referenced field
    assert plan(contract.queries()[name](spark, SF)).count(fn) == 1


def test_big_dimension_join_reuses_window_partitioning(spark):
    # without any broadcast the best rows keep the o_custkey partitioning of
    # the windows for the join: only customer shuffles for it
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(contract.q_best_year_by_series(spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin [o_custkey" in p and "Broadcast" not in p
    assert p.count("Exchange hashpartitioning(o_custkey") == 2  # the sums, and the windows


BUILD_ONLY = sorted(set(contract.core_queries()) - {"raw_files", "medallion_best_year", "medallion_quality", "log_table_state", "incremental_ingest", "landed_files", "ordered_rows"})


def test_building_a_query_runs_no_job(spark):
    # the others write files or tables first, or look whether there are rows; all of these only declare a plan
    tracker = spark.sparkContext.statusTracker()
    tables = [spark.read.parquet(f"{SF}/{t}.parquet").schema for t in ("orders", "pages")]
    assert tables
    for name in BUILD_ONLY:
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        contract.core_queries()[name](spark, SF)
        jobs = [j for j in tracker.getJobIdsForGroup(f"build-{name}")]
        stages = [tracker.getStageInfo(s) for j in jobs for s in tracker.getJobInfo(j).stageIds]
        assert all(s is None or s.name.startswith("parquet at") for s in stages), name  # reading a footer's schema
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_documents_stay_out_of_the_shuffle(spark):
    p = plan(contract.q_document_landing(spark, SF))
    for line in p.splitlines():
        if "Exchange" in line:
            assert "js" not in line
    assert "jsonObjectKeys" in p and "LeftAnti" not in p


def test_log_reduction_combines_before_the_shuffle(spark):
    from strata.plans.manifest import compact_log
    from strata.plans import derived

    log = derived.as_manifest(derived.previous_log(spark.read.parquet(f"{SF}/orders.parquet")), "orders").drop("k")
    p = plan(compact_log(log))
    assert "partial_max_by" in p and p.count("Exchange hashpartitioning") == 1 and "Window" not in p
