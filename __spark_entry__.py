"""

Every query reads the driver's tables (or data Spark derives from them, see
``strata.plans.derived``) in full; the matching DuckDB SQL is the
independent oracle. Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

# Make the package importable however this file is loaded (by path or as a module).
_ROOT = os.path.dirname(os.path.abspath(__file__))
if _ROOT not in sys.path:
    sys.path.insert(0, _ROOT)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.columns import join_url
from strata.operators.analytics import best_period, range_stats, series_with_context, year_range
from strata.operators.changes import action_counts, classify_changes, classify_content, detect_removed
from strata.operators.cleanse import clean_columns, sanitize_columns
from strata.operators.latest import latest_by_key
from strata.operators.preview import preview
from strata.operators.quality import (
    compare_rows,
    duplicate_keys,
    missing_json_keys,
    missing_metadata,
    quality_gate,
    quality_report,
    require_non_empty,
    row_profile,
)
from strata.operators.ranking import top_with_ties
from strata.plans import derived, gold
from strata.plans.documents import land_documents
from strata.plans.manifest import (
    append_records,
    incremental_ingest,
    ingest_step,
    landing_records,
    latest_state,
    latest_success,
    read_log,
    removed_records,
    table_latest_state,
    with_listed_size,
)
from strata.plans.medallion import load_bronze, run_medallion
from strata.plans.runs import runs_table
from strata.plans.tables import table
from strata.session import any_checkpoint_dir, materialize, scratch
from strata.sources.delimited import NO_EXTRA_FIELDS, parse_delimited
from strata.sources.json_records import parse_json_records
from strata.sources.landed import read_landed
from strata.sources.listing import extract_links, parse_listing

try:  # the corpus operators are optional: everything else works without them
    import corpus_pipeline
    from strata.llm import queries as corpus
except ImportError:
    corpus = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- gold answers
def q_best_year_by_series(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    return gold.best_year_by_customer(t("orders"), t("customer"), t("nation"), t("region"))


def q_raw_observations_best_year(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    lines = derived.observation_lines(t("lineitem"))
    return gold.best_year_from_raw_lines(lines, t("supplier"), t("nation"), t("region"))


def q_range_mean_stddev(spark: SparkSession, d: str) -> DataFrame:
    stats = range_stats(
        table(spark, d, "orders"), "o_totalprice", F.year("o_orderdate"), 1996, 1998, where=year_range("o_orderdate", 1996, 1998),
        exact=True,
    )
    return stats.select(F.round("mean_value", 4).alias("mean_value"), F.round("stddev_value", 4).alias("stddev_value"))


def q_series_with_context(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").filter(year_range("o_orderdate", 1996, 1999))
    ctx = orders.groupBy(F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).alias("n_orders"))
    items = table(spark, d, "lineitem").withColumn("yr", F.year("l_shipdate"))
    out = series_with_context(items, ctx, "yr", "yr", ["n_orders"], where=F.col("l_returnflag") == "N")
    return out.select("yr", "l_orderkey", "l_linenumber", "l_quantity", "n_orders")


def q_top_with_ties(spark: SparkSession, d: str) -> DataFrame:
    counts = (
        table(spark, d, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("best_year"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    best = top_with_ties(
        counts, ["o_custkey"], [F.col("n_orders").desc()], latest_by=F.col("best_year").desc(), flag_col="is_latest"
    )
    return best.select("o_custkey", "best_year", "n_orders", "is_latest")


# ------------------------------------------------------------- log reduction
def q_latest_state(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    latest = latest_by_key(events, ["event_type", "user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.select("event_id", "event_type", "user_id", "ts", "value")


def q_latest_success(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select(
        "event_id",
        "user_id",
        "value",
        "ts",
        F.when(F.col("value") < 10, F.lit(None)).otherwise(F.col("value")).alias("version"),
        F.when(F.col("event_type") == "purchase", F.lit("SUCCESS")).otherwise(F.col("event_type")).alias("status"),
    )
    best = latest_success(events, ["user_id"], version_col="version", time_col="ts")
    return best.select("event_id", "user_id", "value", "ts")


# ----------------------------------------------------------- change detection
def _classified(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    prev = latest_success(derived.previous_log(orders), ["k"], version_col="m")
    return classify_changes(derived.current_listing(orders), prev, ["k"], ["sz", "m"])


def q_change_actions(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d).select("k", "action")


def q_action_counts(spark: SparkSession, d: str) -> DataFrame:
    return action_counts(_classified(spark, d))


def _removed(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    state = latest_state(derived.previous_log(orders), ["k"])
    return detect_removed(state, derived.current_listing(orders), ["k"])


def q_removed_keys(spark: SparkSession, d: str) -> DataFrame:
    return _removed(spark, d).select("k")


def q_removed_records(spark: SparkSession, d: str) -> DataFrame:
    removed = _removed(spark, d).select(
        "k", F.col("sz").alias("file_size"), F.col("m").alias("source_modified_time"), "status", "ingestion_time"
    )
    return removed_records(
        removed, derived.run_time(), ["k", "file_size", "source_modified_time", "ingestion_time", "status"]
    )


def q_landing_records(spark: SparkSession, d: str) -> DataFrame:
    landed = derived.landed_files(table(spark, d, "orders"))
    records = landing_records(_classified(spark, d), landed, ["k"], size_col="sz", now=derived.run_time())
    return records.select("k", "action", F.col("sz").alias("file_size"), "status", "size_mismatch")


def q_stale_landing(spark: SparkSession, d: str) -> DataFrame:
    """Three runs over a folder that still holds old copies: a changed file lands only with its new copy."""
    orders = table(spark, d, "orders")
    old, new = derived.two_listings(orders)
    copies = derived.dated_copies(orders)
    log = old.select(F.lit("orders").alias("source"), "file_name", F.lit("").alias("file_path"), "file_size",
                     "source_modified_time", derived.run_time().alias("ingestion_time"), F.lit("SUCCESS").alias("status"))
    now = derived.run_time() + F.expr("INTERVAL 2 DAY")
    step = ingest_step(new, log, copies, "orders", now=now)
    later = ingest_step(new, with_listed_size(log).unionByName(step.records()), copies, "orders", now=now + F.expr("INTERVAL 1 DAY"))
    first = step.records().select("file_name", "status", "file_size")
    again = later.classified.select("file_name", F.col("action").alias("next_action"))
    return first.join(again, "file_name")


def q_best_period_wide_values(spark: SparkSession, d: str) -> DataFrame:
    """Values of many decimals, infinities and NaN: nothing is rounded away or lost before the ranking."""
    value = derived.wide_value()
    best = best_period(table(spark, d, "lineitem"), "l_suppkey", F.year("l_shipdate"), value, exact=True,
                       period_col="y", sum_col="s", flag_col="latest")
    finite = ~F.isnan("s") & (F.abs("s") < F.lit(float("inf")))
    kind = F.when(F.isnan("s"), "nan").when(finite, "number").otherwise("infinity")
    return best.select("l_suppkey", F.col("y").cast("int").alias("y"), kind.alias("kind"),
                       F.round(F.when(finite, F.col("s")), 9).alias("total"), "latest")


def q_incremental_twice(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    inventory = derived.as_manifest(derived.current_listing(orders), "orders").drop("k")
    log = derived.as_manifest(derived.previous_log(orders), "orders").drop("k")
    landed = inventory.select("file_name", F.col("file_size").alias("length"))
    first = ingest_step(inventory, log, landed, "orders", now=derived.run_time())
    grown = first.records().unionByName(log.withColumn("listed_size", F.col("file_size")), allowMissingColumns=True)
    second = ingest_step(inventory, grown, landed, "orders", now=derived.run_time() + F.expr("INTERVAL 1 DAY"))
    return second.counts()


def q_content_changes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    stored = docs.filter(F.col("lang") != "es").select(
        "doc_id",
        F.when(F.col("source").isin("src1", "src2"), F.concat(F.col("text"), F.lit("!")))
        .otherwise(F.col("text"))
        .alias("text"),
    )
    return classify_content(docs.select("doc_id", "text"), stored, ["doc_id"], "text").select("doc_id", "action")


# ------------------------------------------------------------------- sources
def q_extract_links(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    return extract_links(pages, "html", "t", keep=["page_id"]).select("page_id", "file_name")


def q_odd_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of many shapes, extracted and resolved against a base."""
    pages = derived.linked_pages(table(spark, d, "pages"))
    links = extract_links(pages, "html", keep=["page_id"])
    return links.select("page_id", "file_name", join_url("https://host.net/a/b/c?q#f", "href").alias("url"))


def q_landed_files(spark: SparkSession, d: str) -> DataFrame:
    # text files that Spark has written from a table, read back as landed bytes and hashed on the executors
    with scratch(spark) as root:
        written = derived.customer_files(f"{root}/files", table(spark, d, "customer"))
        landed = materialize(read_landed(spark, written, "*.txt", with_hash=True))
    folder = lambda name, kind: F.regexp_extract("relative_path", f"{name}=([0-9]+)", 1).cast(kind).alias(name)
    return landed.select(folder("nation", "int"), folder("part", "long"), "length", "content_sha256")


def q_listing_inventory(spark: SparkSession, d: str) -> DataFrame:
    pages = derived.listing_pages(table(spark, d, "part"))
    inventory = parse_listing(pages, "html", derived.LISTING_BASE, "pr.", keep=["page"])
    # listing times carry no zone: report the wall-clock time as timestamp_ntz
    return inventory.withColumn("source_modified_time", F.col("source_modified_time").cast("timestamp_ntz"))


def q_explode_records(spark: SparkSession, d: str) -> DataFrame:
    docs = derived.conversation_documents(table(spark, d, "conversations"))
    schema = StructType.fromDDL(
        "columns ARRAY<STRING>, data ARRAY<STRUCT<`Conv ID`: BIGINT, `Turn`: BIGINT, `Role`: STRING, "
        "`Line No`: BIGINT, `Line`: STRING>>"
    )
    return parse_json_records(docs, "doc", schema)


def q_read_delimited(spark: SparkSession, d: str) -> DataFrame:
    schema = StructType([StructField(n, StringType()) for n in ("series_id", "value", "note")])
    raw = parse_delimited(derived.delimited_lines(table(spark, d, "orders")), "line", schema)
    return clean_columns(
        raw,
        {"series_id": None, "value": "double"},
        rename={"series_id": "sid", "value": "v"},
        null_tokens={"value": ["-"]},
        keep=["series_id", "note"],
    )


def q_typed_clean(spark: SparkSession, d: str) -> DataFrame:
    raw = derived.raw_part_cells(table(spark, d, "part"))
    return clean_columns(
        raw,
        {"raw_name": None, "raw_size": "int"},
        rename={"raw_name": "nm", "raw_size": "sz"},
        null_tokens={"raw_size": ["-"]},
        keep=["p_partkey"],
    )


def q_sanitize_columns(spark: SparkSession, d: str) -> DataFrame:
    # source-style headers (padding, capitals, punctuation) on a table that grows with the data
    raw = table(spark, d, "customer").toDF(
        " Customer Key ", "Customer-Name", "Nation.Key", "Account Balance ($)", "MKT Segment"
    )
    return sanitize_columns(raw)


# ------------------------------------------------------------------- quality
LINE_RULES = {
    "valid_flag": "l_returnflag IN ('A', 'N')",
    "positive_quantity": "l_quantity > 0",
    "known_line": "NULLIF(l_linenumber, 3) IS NOT NULL",
}
REPORT_RULES = {
    "valid_flag": "l_returnflag IN ('A', 'N')",
    "valid_line": "NULLIF(l_linenumber, 3) > 1",
}


def q_quality_gate(spark: SparkSession, d: str) -> DataFrame:
    kept, _ = quality_gate(table(spark, d, "lineitem"), LINE_RULES)
    return kept.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


def q_quality_report(spark: SparkSession, d: str) -> DataFrame:
    return quality_report(table(spark, d, "lineitem"), REPORT_RULES)


def q_rejected_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of too many and too few fields, counted by rules on what the reader kept."""
    schema = StructType([StructField(n, StringType()) for n in ("series_id", "value", "note")])
    lines = parse_delimited(derived.ragged_lines(table(spark, d, "orders")), "line", schema, extra_col="extra_fields")
    return quality_report(lines, {**NO_EXTRA_FIELDS, "has_note": "note IS NOT NULL", "plain_id": "series_id NOT LIKE '%\t%'"})


def q_row_profile(spark: SparkSession, d: str) -> DataFrame:
    return row_profile(table(spark, d, "events"), "user_id")


def q_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_keys(table(spark, d, "documents"), ["text"], digest=True)


def q_missing_metadata(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id")
    return missing_metadata(docs, table(spark, d, "labels"), ["doc_id"], ["quality", "toxic"]).select("doc_id")


def q_missing_json_keys(spark: SparkSession, d: str) -> DataFrame:
    return missing_json_keys(derived.event_properties(table(spark, d, "events")), "js", ["k"]).select("event_id")


def q_document_landing(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    incoming = derived.event_properties(events).select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("file_name"),
        F.concat(F.lit("/docs/e"), F.col("event_id").cast("string")).alias("file_path"),
        F.col("js"),
    )
    stored = events.filter(F.col("event_type") != "view").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("file_name"), F.col("props").alias("js")
    )
    landing = land_documents(incoming, stored, ["file_name"], "js", ["k"], "EVENTS", now=derived.run_time())
    return landing.records.select("file_name", "file_size", "status")


def q_same_rows(spark: SparkSession, d: str) -> DataFrame:
    """A table against a copy dealt and ordered otherwise, and against one with a row's price changed by a cent."""
    orders = table(spark, d, "orders")
    shuffled = orders.select(*reversed(orders.columns)).repartition(7, "o_custkey").sortWithinPartitions("o_totalprice")
    cent = F.when(F.col("o_orderkey") == 1, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))
    return compare_rows(orders, shuffled).union(compare_rows(orders, shuffled.withColumn("o_totalprice", cent)))


def q_ordered_rows(spark: SparkSession, d: str) -> DataFrame:
    """A whole result in order, guarded against an empty input."""
    orders = require_non_empty(table(spark, d, "orders"), "orders")
    return preview(orders.select("o_orderkey", "o_orderdate", "o_totalprice"), [F.col("o_orderdate"), F.col("o_orderkey")], None)


def q_limited_rows(spark: SparkSession, d: str) -> DataFrame:
    """Some 20 rows, whichever they are: how many there are, and how many of them are rows of the table."""
    orders = table(spark, d, "orders")
    some = preview(orders, n=20)
    own = some.join(orders.select(*[F.col(c).alias(f"t_{c}") for c in orders.columns]), F.col("o_orderkey") == F.col("t_o_orderkey"))
    same = F.col("o_totalprice") == F.col("t_o_totalprice")
    return own.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_own"))


def q_preview(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return preview(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20)


# -------------------------------------------- files and tables that Spark writes
def q_raw_files(spark: SparkSession, d: str) -> DataFrame:
    """Delimited and JSON file readers over raw files derived from the tables."""
    with scratch(spark) as root:
        bronze = load_bronze(spark, *derived.raw_folders(spark, root, lambda n: table(spark, d, n)))
        lines = bronze["bronze_all_data"].select(F.trim("series_id").alias("name"), F.trim("year").alias("year"), F.trim("value").alias("value"))
        years = bronze["bronze_population"].select(
            F.col("nation").alias("name"), F.col("year").cast("string").alias("year"), F.col("population").cast("long").cast("string").alias("value")
        )
        return materialize(lines.unionByName(years))


def _medallion(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, dict[str, int]]]:
    """The six-join gold table and the quality counts of a run whose files and tables are dropped again."""
    database = derived.fresh_name("strata_query")
    try:
        with scratch(spark) as root:
            out = run_medallion(
                spark, *derived.raw_folders(spark, root, lambda n: table(spark, d, n)),
                database=database, nation="NATION_3", series_id="PRS1", years=(1995, 1997), exact_sums=True,
            )
            return materialize(out.tables["gold_best_year"]), out.quality
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def q_medallion_best_year(spark: SparkSession, d: str) -> DataFrame:
    """Raw files to bronze, silver and gold tables; the gold table of the six-join star."""
    best, _ = _medallion(spark, d)
    return best.select("series_id", "best_year", F.round("yearly_quarterly_sum", 2).alias("total"), "is_latest_best_year", "series_description")


def q_medallion_quality(spark: SparkSession, d: str) -> DataFrame:
    """Rows and drops counted while the gated silver tables were written."""
    _, counts = _medallion(spark, d)
    rows = [(t, k, v) for t, own in counts.items() for k, v in own.items()]
    return spark.createDataFrame(rows, "silver_table string, metric string, n long")


@contextmanager
def _log_tables(spark: SparkSession, *kinds: str) -> Iterator[list[str]]:
    """Names for tables that are dropped at the end of the block, with their run tables."""
    any_checkpoint_dir(spark)
    names = [derived.fresh_name(f"strata_{k}") for k in kinds]
    try:
        yield names
    finally:
        for name in [*names, *map(runs_table, names)]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def q_log_table_state(spark: SparkSession, d: str) -> DataFrame:
    """Append records to a log table twice, then read its latest state back."""
    log = derived.as_manifest(derived.previous_log(table(spark, d, "orders")), "orders").drop("k")
    with _log_tables(spark, "log") as [name]:
        append_records(log, name, partition_by=("source",))
        gone = removed_records(log.filter("status = 'SUCCESS' AND source_modified_time IS NULL"), derived.run_time() + F.expr("INTERVAL 5 DAY"))
        append_records(gone, name, partition_by=("source",))
        return materialize(table_latest_state(spark, name, "orders").select("file_name", "file_size", "status"))


def q_incremental_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Runs against a log and its state: names that landed twice, a run repeated under its id, two runs at one time."""
    orders = table(spark, d, "orders")
    inventory = derived.as_manifest(derived.current_listing(orders), "orders").drop("k")
    old = with_listed_size(derived.as_manifest(derived.previous_log(orders), "orders").drop("k"))
    landed = derived.landed_twice(orders)
    with _log_tables(spark, "log", "state") as [log, state]:
        append_records(old, log, partition_by=("source",), run_id="history")
        append_records(old, log, partition_by=("source",), run_id="history")
        step = lambda run_id, keep: incremental_ingest(
            spark, inventory, landed, log, "orders", now=derived.run_time(), run_id=run_id, state_table=keep, state_buckets=8
        )
        for run_id, keep in (("first", state), ("first", state), ("second", None), ("third", state)):
            step(run_id, keep)
        rows = read_log(spark, log).groupBy("file_name").agg(F.count(F.lit(1)).alias("n_records"))
        now = table_latest_state(spark, log, "orders").select("file_name", "file_size", "status")
        return materialize(now.join(rows, "file_name"))


# ------------------------------------------------------------------ contract
def entry(spark: SparkSession) -> DataFrame:
    return q_best_year_by_series(spark, "/root/testdata/sf0.001")


def core_queries() -> dict[str, Query]:
    """The queries of the library itself; each has an oracle."""
    return {
        "best_year_by_series": q_best_year_by_series,
        "raw_observations_best_year": q_raw_observations_best_year,
        "range_mean_stddev": q_range_mean_stddev,
        "series_with_context": q_series_with_context,
        "top_with_ties": q_top_with_ties,
        "latest_state": q_latest_state,
        "latest_success": q_latest_success,
        "change_actions": q_change_actions,
        "action_counts": q_action_counts,
        "removed_keys": q_removed_keys,
        "removed_records": q_removed_records,
        "landing_records": q_landing_records,
        "incremental_twice": q_incremental_twice,
        "stale_landing": q_stale_landing,
        "best_period_wide_values": q_best_period_wide_values,
        "raw_files": q_raw_files,
        "medallion_best_year": q_medallion_best_year,
        "medallion_quality": q_medallion_quality,
        "log_table_state": q_log_table_state,
        "incremental_ingest": q_incremental_ingest,
        "content_changes": q_content_changes,
        "extract_links": q_extract_links,
        "odd_links": q_odd_links,
        "landed_files": q_landed_files,
        "listing_inventory": q_listing_inventory,
        "explode_records": q_explode_records,
        "read_delimited": q_read_delimited,
        "typed_clean": q_typed_clean,
        "sanitize_columns": q_sanitize_columns,
        "quality_gate": q_quality_gate,
        "quality_report": q_quality_report,
        "rejected_lines": q_rejected_lines,
        "row_profile": q_row_profile,
        "duplicate_keys": q_duplicate_keys,
        "missing_metadata": q_missing_metadata,
        "missing_json_keys": q_missing_json_keys,
        "document_landing": q_document_landing,
        "preview": q_preview,
        "same_rows": q_same_rows,
        "ordered_rows": q_ordered_rows,
        "limited_rows": q_limited_rows,
    }


def queries() -> dict[str, Query]:
    out = core_queries()
    if corpus is not None:
        out |= corpus.queries() | {"pipeline": corpus_pipeline.run}
    return out


# Shared CTEs for the change-detection oracles (same derivation as strata.plans.derived).
_SNAPSHOTS = """
cur AS (SELECT o_orderkey AS k, CAST(ROUND(o_totalprice*100) AS BIGINT) AS sz, o_orderdate AS m
        FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'),
prev AS (SELECT o_orderkey AS k,
    CAST(ROUND(o_totalprice*100) AS BIGINT) + CASE WHEN o_orderpriority='1-URGENT' THEN 1 ELSE 0 END AS sz,
    CASE WHEN o_orderpriority='2-HIGH' THEN NULL
         WHEN o_orderpriority='3-MEDIUM' AND o_orderstatus='O' THEN o_orderdate - INTERVAL 1 DAY
         ELSE o_orderdate END AS m,
    CASE WHEN o_orderpriority='5-LOW' THEN 'REMOVED'
         WHEN o_orderpriority='4-NOT SPECIFIED' AND o_orderstatus='P' THEN 'FAILED'
         ELSE 'SUCCESS' END AS status
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
act AS (SELECT cur.k, cur.sz, cur.m,
    CASE WHEN prev.k IS NULL THEN 'NEW' WHEN cur.sz<>prev.sz OR cur.m<>prev.m THEN 'CHANGED' ELSE 'UNCHANGED' END AS action
    FROM cur LEFT JOIN prev ON cur.k=prev.k AND prev.status='SUCCESS')
"""

# The raw files of strata.plans.derived.raw_folders, as tables.
_RAW = """
WITH obs AS (SELECT concat('PRS', l_suppkey) AS name, CAST(year(l_shipdate) AS VARCHAR) AS year,
                    concat('Q0', quarter(l_shipdate)) AS quarter,
                    CASE WHEN l_discount = 0 THEN '-' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS value FROM lineitem),
pop AS (SELECT n.n_name AS nation, year(o.o_orderdate) AS year, COUNT(*) AS population FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2)"""


def oracle_sql() -> dict[str, str]:
    out = core_oracles()
    if corpus is not None:
        out |= corpus.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


def core_oracles() -> dict[str, str]:
    return {
        "best_year_by_series": """
WITH ys AS (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS y, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s
            FROM orders WHERE o_orderstatus IN ('F','O') GROUP BY o_custkey, year(o_orderdate)),
r AS (SELECT *, DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY s DESC) rk FROM ys),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY y DESC) rn FROM r WHERE rk=1)
SELECT b.o_custkey AS series_id, b.y AS best_year, ROUND(CAST(b.s AS DOUBLE), 3) AS yearly_sum,
       b.rn=1 AS is_latest_best_year, n.n_name, g.r_name,
       concat_ws(' | ', c.c_mktsegment, n.n_name, g.r_name) AS series_description
FROM b LEFT JOIN customer c ON b.o_custkey=c.c_custkey LEFT JOIN nation n ON c.c_nationkey=n.n_nationkey
       LEFT JOIN region g ON n.n_regionkey=g.r_regionkey""",
        "raw_observations_best_year": """
WITH obs AS (SELECT concat('PRS', l_suppkey) AS series_id, CAST(year(l_shipdate) AS INT) AS y,
                    SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS s
             FROM lineitem WHERE l_discount <> 0 AND l_extendedprice IS NOT NULL AND l_shipdate IS NOT NULL
             GROUP BY l_suppkey, year(l_shipdate)),
r AS (SELECT *, DENSE_RANK() OVER (PARTITION BY series_id ORDER BY s DESC) rk FROM obs),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY y DESC) rn FROM r WHERE rk=1)
SELECT b.series_id, b.y AS best_year, ROUND(CAST(b.s AS DOUBLE), 3) AS yearly_quarterly_sum,
       b.rn=1 AS is_latest_best_year, n.n_name, g.r_name, concat_ws(' | ', n.n_name, g.r_name) AS series_description
FROM b LEFT JOIN supplier su ON b.series_id = concat('PRS', su.s_suppkey)
       LEFT JOIN nation n ON su.s_nationkey=n.n_nationkey LEFT JOIN region g ON n.n_regionkey=g.r_regionkey""",
        "range_mean_stddev": """
SELECT ROUND(AVG(o_totalprice), 4) AS mean_value, ROUND(STDDEV_POP(o_totalprice), 4) AS stddev_value
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998""",
        "series_with_context": """
WITH ctx AS (SELECT CAST(year(o_orderdate) AS INT) AS yr, COUNT(*) AS n_orders FROM orders
             WHERE year(o_orderdate) BETWEEN 1996 AND 1999 GROUP BY year(o_orderdate))
SELECT CAST(year(l.l_shipdate) AS INT) AS yr, l.l_orderkey, l.l_linenumber, l.l_quantity, ctx.n_orders
FROM lineitem l LEFT JOIN ctx ON year(l.l_shipdate)=ctx.yr WHERE l.l_returnflag='N'""",
        "top_with_ties": """
WITH ys AS (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS y, COUNT(*) AS s FROM orders GROUP BY o_custkey, year(o_orderdate)),
r AS (SELECT *, DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY s DESC) rk FROM ys)
SELECT o_custkey, y AS best_year, s AS n_orders,
       ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY y DESC)=1 AS is_latest FROM r WHERE rk=1""",
        "latest_state": """
SELECT event_id, event_type, user_id, ts, value FROM (SELECT *, ROW_NUMBER() OVER
  (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) rn FROM events) t WHERE rn=1""",
        "latest_success": """
SELECT event_id, user_id, value, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
  ORDER BY CASE WHEN value < 10 THEN NULL ELSE value END DESC NULLS LAST, ts DESC, event_id DESC) rn
  FROM events WHERE event_type='purchase') t WHERE rn=1""",
        "change_actions": f"WITH {_SNAPSHOTS} SELECT k, action FROM act",
        "action_counts": f"WITH {_SNAPSHOTS} SELECT action, COUNT(*) AS n FROM act GROUP BY action",
        "removed_keys": f"""WITH {_SNAPSHOTS}
SELECT p.k FROM prev p WHERE p.status='SUCCESS' AND NOT EXISTS (SELECT 1 FROM cur WHERE cur.k=p.k)""",
        "removed_records": f"""WITH {_SNAPSHOTS}
SELECT p.k, p.sz AS file_size, p.m AS source_modified_time, TIMESTAMP '2026-01-01 00:00:00' AS ingestion_time,
       'REMOVED' AS status FROM prev p LEFT JOIN cur c ON p.k=c.k WHERE p.status='SUCCESS' AND c.k IS NULL""",
        "landing_records": f"""WITH {_SNAPSHOTS},
landed AS (SELECT o_orderkey AS lk,
    CAST(ROUND(o_totalprice*100) AS BIGINT) + CASE WHEN o_orderpriority='3-MEDIUM' THEN 5 ELSE 0 END AS length
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus <> 'P')
SELECT a.k, a.action, CASE WHEN l.lk IS NULL THEN a.sz ELSE l.length END AS file_size,
       CASE WHEN l.lk IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       COALESCE(l.length<>a.sz, FALSE) AS size_mismatch
FROM act a LEFT JOIN landed l ON a.k=l.lk WHERE a.action IN ('NEW','CHANGED')""",
        "incremental_twice": f"""WITH {_SNAPSHOTS},
log AS (SELECT k, sz, m, 1 AS run, status FROM prev
        UNION ALL SELECT k, sz, m, 2, 'SUCCESS' FROM act WHERE action IN ('NEW','CHANGED')),
succ AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY m DESC NULLS LAST, run DESC) rn
         FROM log WHERE status='SUCCESS') t WHERE rn=1)
SELECT CASE WHEN s.k IS NULL THEN 'NEW' WHEN c.sz<>s.sz OR c.m<>s.m THEN 'CHANGED' ELSE 'UNCHANGED' END AS action,
       COUNT(*) AS n
FROM cur c LEFT JOIN succ s ON c.k=s.k GROUP BY 1""",
        "content_changes": """
WITH p AS (SELECT doc_id, sha256(CASE WHEN source IN ('src1','src2') THEN concat(text,'!') ELSE text END) h
           FROM documents WHERE lang <> 'es')
SELECT d.doc_id, CASE WHEN p.doc_id IS NULL THEN 'NEW' WHEN p.h<>sha256(d.text) THEN 'CHANGED' ELSE 'UNCHANGED' END AS action
FROM documents d LEFT JOIN p ON d.doc_id=p.doc_id""",
        "extract_links": r"""
SELECT page_id, file_name FROM (
  SELECT page_id, split_part(regexp_replace(href, '/+$', ''), '/', -1) AS file_name FROM (
    SELECT page_id,
           replace(replace(replace(replace(replace(regexp_replace(raw, '^["'']|["'']$', '', 'g'),
             '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS href
    FROM (SELECT page_id, unnest(regexp_extract_all(
            regexp_replace(html, '(?is)<(?:!--.*?-->|script\b[^>]*>.*?</script\s*>|style\b[^>]*>.*?</style\s*>)', '', 'g'),
                                 '(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1)) AS raw
          FROM pages) r) t) u
WHERE file_name LIKE 't%'""",
        "odd_links": """
SELECT page_id, unnest(['t' || page_id || '.txt', 't' || page_id || '.csv', 't' || page_id || '.x', 't>' || page_id, 'mailto:s@x.org']) AS file_name,
       unnest(['https://host.net/a/b/t' || page_id || '.txt', 'https://host.org/x/t' || page_id || '.csv',
               'https://host.net/a/up/t' || page_id || '.x/', 'https://x.org/t>' || page_id, 'mailto:s@x.org']) AS url FROM pages""",
        "landed_files": """
SELECT c_nationkey AS nation, part, CAST(strlen(t) AS BIGINT) AS length, sha256(t) AS content_sha256
FROM (SELECT c_nationkey, CAST(c_custkey // 1000 AS BIGINT) AS part, string_agg(c_name || chr(10), '' ORDER BY c_custkey) AS t
      FROM customer GROUP BY ALL) f""",
        "listing_inventory": """
SELECT p_partkey AS page, concat('pr.', p_partkey) AS file_name,
       concat('https://x.org/pub/pr.', p_partkey) AS source_url,
       CAST(ROUND(p_retailprice*100) AS BIGINT) AS file_size,
       make_timestamp(2026, 8, least(p_size, 28), CASE WHEN p_size > 25 THEN 20 ELSE 8 END, 30, 0) AS source_modified_time
FROM part""",
        "explode_records": """
SELECT conv_id, turn, role, CAST(line_no AS BIGINT) AS line_no, line FROM (
  SELECT conv_id, turn, role, generate_subscripts(parts, 1) AS line_no, unnest(parts) AS line
  FROM (SELECT conv_id, turn, role, string_split(text, chr(10)) AS parts FROM conversations) t) u""",
        "read_delimited": """
SELECT concat('S', o_custkey, '   ') AS series_id, concat('S', o_custkey) AS sid,
       CASE WHEN o_orderstatus='P' THEN NULL ELSE CAST(o_orderkey AS DOUBLE) END AS v,
       CASE WHEN o_orderpriority='5-LOW' THEN NULL ELSE 'R' END AS note FROM orders""",
        "typed_clean": """
SELECT p_partkey, trim(raw_name) AS nm,
       TRY_CAST(CASE WHEN trim(raw_size)='-' THEN NULL ELSE trim(raw_size) END AS INT) AS sz
FROM (SELECT p_partkey, concat('  ', p_name, ' ') AS raw_name,
             CASE WHEN p_size < 5 THEN ' - ' WHEN p_type='PROMO' THEN 'n/a'
                  ELSE concat(' ', CAST(p_size AS VARCHAR), ' ') END AS raw_size FROM part) t""",
        "sanitize_columns": """
SELECT c_custkey AS customer_key, c_name AS customer_name, c_nationkey AS nation_key,
       c_acctbal AS account_balance, c_mktsegment AS mkt_segment FROM customer""",
        "quality_gate": """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
WHERE COALESCE(l_returnflag IN ('A','N'), FALSE) AND COALESCE(l_quantity > 0, FALSE)
  AND COALESCE(NULLIF(l_linenumber, 3) IS NOT NULL, FALSE)""",
        "quality_report": """
SELECT 'valid_flag' AS rule, COUNT(*) AS n_rows,
       CAST(SUM(CASE WHEN COALESCE(l_returnflag IN ('A','N'), FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS n_failed FROM lineitem
UNION ALL
SELECT 'valid_line', COUNT(*),
       CAST(SUM(CASE WHEN COALESCE(NULLIF(l_linenumber, 3) > 1, FALSE) THEN 0 ELSE 1 END) AS BIGINT) FROM lineitem""",
        "rejected_lines": """
SELECT unnest(['no_extra_fields', 'has_note', 'plain_id']) AS rule, COUNT(*) AS n_rows,
       unnest([COUNT(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END), COUNT(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END),
               COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END)]) AS n_failed FROM orders""",
        "row_profile": "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT user_id) AS distinct_keys FROM events",
        "duplicate_keys": "SELECT text, COUNT(*) AS n FROM documents GROUP BY text HAVING COUNT(*) > 1",
        "missing_metadata": """
SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id=l.doc_id WHERE l.quality IS NULL OR l.toxic IS NULL""",
        "missing_json_keys": """
SELECT event_id FROM (SELECT event_id, CASE WHEN event_type='error' THEN '{"z":1}'
                                             WHEN event_type='signup' THEN '{"k":null}' ELSE props END AS js FROM events) t
WHERE NOT COALESCE(list_contains(json_keys(js), 'k'), FALSE)""",
        "document_landing": """
WITH inc AS (SELECT event_id, CASE WHEN event_type='error' THEN '{"z":1}'
                                   WHEN event_type='signup' THEN '{"k":null}' ELSE props END AS js FROM events),
valid AS (SELECT * FROM inc WHERE COALESCE(list_contains(json_keys(js), 'k'), FALSE)),
st AS (SELECT event_id, props FROM events WHERE event_type <> 'view')
SELECT concat('e', v.event_id) AS file_name, CAST(strlen(v.js) AS BIGINT) AS file_size, 'SUCCESS' AS status
FROM valid v LEFT JOIN st s ON v.event_id = s.event_id
WHERE s.event_id IS NULL OR sha256(v.js) <> sha256(s.props)""",
        "stale_landing": """
SELECT concat('f', o_orderkey) AS file_name,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       CAST(ROUND(o_totalprice*100) AS BIGINT) + 1 AS file_size,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'UNCHANGED' ELSE 'CHANGED' END AS next_action
FROM orders WHERE o_orderstatus <> 'F'""",
        "best_period_wide_values": """
WITH v AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS y, CASE WHEN l_quantity = 50 AND l_discount = 0.1 THEN 1 ELSE 0 END AS inf,
                  CASE WHEN l_quantity = 49 AND l_discount = 0.1 THEN 1 ELSE 0 END AS nan, CAST(l_quantity AS DECIMAL(18,9)) / 10000000 AS x
           FROM lineitem),
t AS (SELECT l_suppkey, y, CASE WHEN max(nan) = 1 THEN 3 WHEN max(inf) = 1 THEN 2 ELSE 1 END AS k,
             SUM(CASE WHEN inf + nan = 0 THEN CAST(x AS DECIMAL(38,15)) END) AS s FROM v GROUP BY l_suppkey, y),
r AS (SELECT *, CASE WHEN k = 1 THEN s ELSE 0 END AS z FROM t),
b AS (SELECT *, DENSE_RANK() OVER (PARTITION BY l_suppkey ORDER BY k DESC, z DESC) AS rk FROM r)
SELECT l_suppkey, y, CASE k WHEN 3 THEN 'nan' WHEN 2 THEN 'infinity' ELSE 'number' END AS kind,
       CASE WHEN k = 1 THEN ROUND(CAST(s AS DOUBLE), 9) END AS total, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY y DESC) = 1 AS latest
FROM b WHERE rk = 1""",
        "raw_files": f"""{_RAW}
SELECT name, year, value FROM obs
UNION ALL SELECT nation, CAST(year AS VARCHAR), CAST(population AS VARCHAR) FROM pop""",
        "medallion_best_year": f"""{_RAW},
ys AS (SELECT name AS series_id, CAST(year AS INT) AS y, SUM(CAST(value AS DECIMAL(18,2))) AS s FROM obs
       WHERE value <> '-' AND quarter <> 'Q05' GROUP BY 1, 2),
r AS (SELECT *, s = MAX(s) OVER (PARTITION BY series_id) AS top FROM ys)
SELECT r.series_id, r.y AS best_year, ROUND(CAST(r.s AS DOUBLE), 2) AS total, r.y = MAX(r.y) OVER (PARTITION BY r.series_id) AS is_latest_best_year,
       concat_ws(' | ', n.n_name, 'class ' || n.n_regionkey, g.r_name, CASE WHEN su.s_acctbal < 0 THEN 'short' ELSE 'long' END, 'adjusted') AS series_description
FROM r JOIN supplier su ON r.series_id = 'PRS' || su.s_suppkey JOIN nation n ON su.s_nationkey = n.n_nationkey
JOIN region g ON n.n_regionkey = g.r_regionkey WHERE r.top""",
        "medallion_quality": f"""{_RAW}
SELECT 'silver_observations' AS silver_table, unnest(['rows', 'failed_valid_observation']) AS metric,
       unnest([COUNT(*), COUNT(CASE WHEN value = '-' THEN 1 END)]) AS n FROM obs
UNION ALL SELECT 'silver_series', unnest(['rows', 'failed_valid_series']), unnest([COUNT(*), 0]) FROM supplier
UNION ALL SELECT 'silver_population', unnest(['rows', 'failed_valid_population']), unnest([COUNT(*), COUNT(CASE WHEN nation <> 'NATION_3' THEN 1 END)]) FROM pop""",
        "log_table_state": f"""WITH {_SNAPSHOTS}
SELECT CAST(k AS VARCHAR) AS file_name, sz AS file_size, CASE WHEN status = 'SUCCESS' AND m IS NULL THEN 'REMOVED' ELSE status END AS status
FROM prev""",
        "incremental_ingest": f"""WITH {_SNAPSHOTS},
j AS (SELECT COALESCE(cur.k, prev.k) AS k, cur.k IS NOT NULL AS listed, prev.k IS NOT NULL AS logged, act.action, cur.sz, prev.sz AS psz, prev.status AS pst
      FROM cur FULL JOIN prev ON cur.k = prev.k LEFT JOIN act ON act.k = cur.k),
o AS (SELECT j.*, o_orderstatus <> 'P' AS landed, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 5 ELSE 0 END AS more FROM j JOIN orders ON o_orderkey = k),
w AS (SELECT *, listed AND action <> 'UNCHANGED' AS todo, NOT listed AND pst = 'SUCCESS' AS gone FROM o)
SELECT CAST(k AS VARCHAR) AS file_name, CASE WHEN todo AND landed THEN sz + more WHEN todo THEN sz ELSE psz END AS file_size,
       CASE WHEN todo AND landed THEN 'SUCCESS' WHEN todo THEN 'FAILED' WHEN gone THEN 'REMOVED' ELSE pst END AS status,
       CAST(logged AS BIGINT) + CASE WHEN todo AND landed THEN 1 WHEN todo THEN 3 WHEN gone THEN 1 ELSE 0 END AS n_records FROM w""",
        "same_rows": """
SELECT COUNT(*) AS n_left, COUNT(*) AS n_right, TRUE AS same FROM orders
UNION ALL SELECT COUNT(*), COUNT(*), COUNT(CASE WHEN o_orderkey = 1 THEN 1 END) = 0 FROM orders""",
        "ordered_rows": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders",
        "limited_rows": "SELECT least(20, COUNT(*)) AS n_rows, least(20, COUNT(*)) AS n_own FROM orders",
        "preview": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    }
