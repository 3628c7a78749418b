"""Inputs for the library's operators, derived by Spark from the driver's tables.

The library works on listings, ingestion logs, landed files and raw text.
These functions build those shapes from the TPC-H-style tables so that every
registered query reads whole tables and grows with them. Snapshots differ by
*data attributes* (date windows, priority, status), never by id sampling.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values shared with the oracle SQL in __spark_entry__.py.
CURRENT_FROM = "1996-01-01"  # the current listing holds orders from this date on
PREVIOUS_BEFORE = "2000-01-01"  # the previous run saw orders before this date
PREVIOUS_RUN = datetime(2025, 12, 31)
THIS_RUN = datetime(2026, 1, 1)
LISTING_BASE = "https://x.org/pub/"


def run_time(when: datetime = THIS_RUN) -> Column:
    """A fixed, zone-free run time (``timestamp_ntz``), equal in every session time zone."""
    return F.lit(when.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def cents(price: str) -> Column:
    return F.round(F.col(price) * 100).cast("bigint")


def current_listing(orders: DataFrame) -> DataFrame:
    """``(k, sz, m)``: every order placed since CURRENT_FROM, size = price in cents."""
    return orders.filter(F.col("o_orderdate") >= F.lit(CURRENT_FROM).cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("k"), cents("o_totalprice").alias("sz"), F.col("o_orderdate").alias("m")
    )


def previous_log(orders: DataFrame) -> DataFrame:
    """``(k, sz, m, status, ingestion_time)``: the log of the previous run.

    Urgent orders were listed one cent smaller (size change); high-priority
    orders have no source time (NULL comparison); open medium orders were a
    day older (time change); low-priority items were already REMOVED and
    pending not-specified ones FAILED.
    """
    pri, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    return orders.filter(F.col("o_orderdate") < F.lit(PREVIOUS_BEFORE).cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("k"),
        (cents("o_totalprice") + F.when(pri == "1-URGENT", 1).otherwise(0)).alias("sz"),
        F.when(pri == "2-HIGH", F.lit(None))
        .when((pri == "3-MEDIUM") & (st == "O"), F.col("o_orderdate") - F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("o_orderdate"))
        .alias("m"),
        F.when(pri == "5-LOW", "REMOVED")
        .when((pri == "4-NOT SPECIFIED") & (st == "P"), "FAILED")
        .otherwise("SUCCESS")
        .alias("status"),
        run_time(PREVIOUS_RUN).alias("ingestion_time"),
    )


def landed_files(orders: DataFrame) -> DataFrame:
    """``(k, length)``: what this run landed. Pending orders failed to land;
    medium-priority files came out 5 bytes longer than listed."""
    cur = orders.filter(F.col("o_orderdate") >= F.lit(CURRENT_FROM).cast("timestamp_ntz"))
    return cur.filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("k"),
        (cents("o_totalprice") + F.when(F.col("o_orderpriority") == "3-MEDIUM", 5).otherwise(0)).alias("length"),
    )


def landed_twice(orders: DataFrame) -> DataFrame:
    """``(file_name, length, modification_time)``: the files of ``landed_files`` as written a day
    after the run began, each beside a shorter copy from before it."""
    files = landed_files(orders).select(F.col("k").cast("string").alias("file_name"), "length")
    copy = lambda size, at: F.struct(size.alias("length"), at.alias("modification_time"))
    copies = F.array(
        copy(F.col("length") - 1, run_time(PREVIOUS_RUN)), copy(F.col("length"), run_time() + F.expr("INTERVAL 1 DAY"))
    )
    return files.select("file_name", F.inline(copies))


def as_manifest(df: DataFrame, source: str) -> DataFrame:
    """Map ``(k, sz, m[, status, ingestion_time])`` onto the log / inventory column names."""
    out = df.withColumnRenamed("sz", "file_size").withColumnRenamed("m", "source_modified_time")
    out = out.withColumn("file_name", F.col("k").cast("string")).withColumn("source", F.lit(source))
    return out.withColumn("file_path", F.concat(F.lit(f"/landing/{source}/"), F.col("file_name")))


def listing_pages(part: DataFrame) -> DataFrame:
    """``(page, html)``: one directory-listing page per part.

    Each page holds a parent-directory link, the part's ``pr.<key>`` entry
    (size = retail price in cents, time from ``p_size``; tag case and
    absolute/relative href vary with the part type) and a ``readme.txt``
    entry that must be ignored.
    """
    day = F.least(F.col("p_size"), F.lit(28)).cast("string")
    ampm = F.when(F.col("p_size") > 25, "PM").otherwise("AM")
    key = F.col("p_partkey").cast("string")
    upper = F.col("p_type").isin("ECONOMY", "LARGE", "MEDIUM")
    href = F.when(F.col("p_type") == "SMALL", F.concat(F.lit("pr."), key)).otherwise(F.concat(F.lit("/pub/pr."), key))
    a_open = F.when(upper, F.lit('<A HREF="')).otherwise(F.lit('<a href="'))
    a_close = F.when(upper, F.lit("</A>")).otherwise(F.lit("</a>"))
    entry = F.concat(
        F.lit("8/"), day, F.lit("/2026  8:30 "), ampm, F.lit("     "), cents("p_retailprice").cast("string"),
        F.lit(" "), a_open, href, F.lit('">pr.'), key, a_close, F.lit("<br>"),
    )
    html = F.concat(
        F.lit('<html><body><pre><A HREF="/">[To Parent Directory]</A><br><br>'),
        entry,
        F.lit(' 1/2/2026  9:05 AM        512 <A HREF="/pub/readme.txt">readme.txt</A><br></pre></body></html>'),
    )
    return part.select(F.col("p_partkey").alias("page"), html.alias("html"))


def conversation_documents(conversations: DataFrame) -> DataFrame:
    """``(doc)``: one JSON document per conversation turn,
    ``{"columns": [...], "data": [one record per text line]}``, with source-style
    field names (blanks, capitals) that the reader must sanitise."""
    names = ["Conv ID", "Turn", "Role", "Line No", "Line"]
    records = F.transform(
        F.split(F.col("text"), "\n"),
        lambda line, i: F.struct(
            F.col("conv_id").alias("Conv ID"),
            F.col("turn").alias("Turn"),
            F.col("role").alias("Role"),
            (i + 1).alias("Line No"),
            line.alias("Line"),
        ),
    )
    doc = F.to_json(F.struct(F.array(*[F.lit(n) for n in names]).alias("columns"), records.alias("data")))
    return conversations.select(doc.alias("doc"))


def delimited_lines(orders: DataFrame) -> DataFrame:
    """``(line)``: tab-separated observation lines with padded cells, a ``-``
    sentinel for pending orders and a missing last field for low priority."""
    value = F.when(F.col("o_orderstatus") == "P", F.lit("-")).otherwise(
        F.concat(F.lit("   "), F.col("o_orderkey").cast("string"))
    )
    note = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.lit("\tR"))
    line = F.concat(F.lit("S"), F.col("o_custkey").cast("string"), F.lit("   \t"), value, note)
    return orders.select(line.alias("line"))


def ragged_lines(orders: DataFrame) -> DataFrame:
    """``(line)``: three fields a line; urgent orders have two more, low priorities lack the last, and a
    quoted field holds a separator."""
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")
    pri = F.col("o_orderpriority")
    tail = F.when(pri == "5-LOW", F.lit("")).when(pri == "1-URGENT", F.lit("\tR\tmore\teven more")).otherwise(F.lit("\tR"))
    quoted = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit('"'), key, F.lit('\t"'))).otherwise(key)
    return orders.select(F.concat(quoted, F.lit("\t"), price, tail).alias("line"))


def raw_part_cells(part: DataFrame) -> DataFrame:
    """``(p_partkey, raw_name, raw_size)``: padded text cells, ``-`` sentinel for
    small parts and a malformed ``n/a`` for promo parts."""
    raw_size = (
        F.when(F.col("p_size") < 5, F.lit(" - "))
        .when(F.col("p_type") == "PROMO", F.lit("n/a"))
        .otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")))
    )
    return part.select(
        "p_partkey", F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("raw_name"), raw_size.alias("raw_size")
    )


def event_properties(events: DataFrame) -> DataFrame:
    """``(event_id, js)``: error events carry an object without ``k``, signups
    ``{"k": null}`` (present), the rest their own properties."""
    js = (
        F.when(F.col("event_type") == "error", F.lit('{"z":1}'))
        .when(F.col("event_type") == "signup", F.lit('{"k":null}'))
        .otherwise(F.col("props"))
    )
    return events.select("event_id", js.alias("js"))


def observation_lines(lineitem: DataFrame) -> DataFrame:
    """``(line)``: one raw tab-separated observation per line item:
    ``PRS<supplier>   \\t<ship year>\\t Q0<ship quarter>\\t  <price>\\t``.
    Cells are padded; items without discount carry a malformed ``-`` value
    and lose the row in the quality gate."""
    value = F.when(F.col("l_discount") == 0, F.lit("-")).otherwise(
        F.concat(F.lit("  "), F.col("l_extendedprice").cast("string"))
    )
    line = F.concat_ws(
        "\t",
        F.concat(F.lit("PRS"), F.col("l_suppkey").cast("string"), F.lit("   ")),
        F.year("l_shipdate").cast("string"),
        F.concat(F.lit(" Q0"), F.quarter("l_shipdate").cast("string")),
        value,
        F.lit(""),
    )
    return lineitem.select(line.alias("line"))


# ------------------------------------------------- a landing that goes stale
def two_listings(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The listings of two runs: every order is a file; those not finished grew by a byte and a day since."""
    name = F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("file_name")
    grew = F.when(F.col("o_orderstatus") != "F", 1).otherwise(0)
    later = F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate"))
    old = orders.select(name, cents("o_totalprice").alias("file_size"), F.col("o_orderdate").alias("source_modified_time"))
    new = orders.select(name, (cents("o_totalprice") + grew).alias("file_size"), later.alias("source_modified_time"))
    return old, new


def dated_copies(orders: DataFrame) -> DataFrame:
    """What lies in the folder: new copies of the two highest priorities, old ones of all others."""
    fresh = (F.col("o_orderstatus") != "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return orders.select(
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("file_name"),
        (cents("o_totalprice") + F.when(fresh, 1).otherwise(0)).alias("length"),
        F.when(fresh, run_time() + F.expr("INTERVAL 1 DAY")).otherwise(run_time(PREVIOUS_RUN)).alias("modification_time"),
    )


def wide_value() -> Column:
    """A line item's quantity in ten millionths; infinite or NaN for a few."""
    ten = F.col("l_discount") == 0.1
    return (
        F.when(ten & (F.col("l_quantity") == 50), F.lit(float("inf")))
        .when(ten & (F.col("l_quantity") == 49), F.lit(float("nan")))
        .otherwise(F.col("l_quantity") / F.lit(1e7))
    )


def linked_pages(pages: DataFrame) -> DataFrame:
    """Each page's id in links of many shapes: ``data-href`` beside ``href``, ``>`` in a quoted value,
    numeric references, relative and scheme-less links; and in places that are no link."""
    key = F.col("page_id").cast("string")
    parts = [
        '<a data-href="t0.wrong" href="t', key, '.txt">1</a>', "<A title='a > b' HREF='//host.org/x/t", key, "&#46;csv'>2</A>",
        '<a\nhref = ../up/./t', key, '&#x2e;x/>3</a>', '<a href="https://x.org/t&gt;', key, '">4</a>',
        '<a name="t.none">5</a><abbr href="t.no">6</abbr><!-- <a href="t.hidden">7</a> -->',
        '<script>var a = \'<a href="t.code">\';</script><a href="mailto:s@x.org">8</a><a href>9</a>',
    ]
    return pages.select("page_id", F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("html"))


# ------------------------------------------------------ files written by Spark
def fresh_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


CUSTOMERS_A_FILE = 1000


def customer_files(path: str, customer: DataFrame) -> str:
    """A folder with text files of customers' names, a line each, by key: a file for each nation and thousand keys.

    Tasks move their own files into place when they end; else the driver would
    move every file, one after another, when all have ended.
    """
    part = F.floor(F.col("c_custkey") / CUSTOMERS_A_FILE).alias("part")
    lines = customer.select(F.col("c_nationkey").alias("nation"), part, "c_custkey", F.col("c_name").alias("value"))
    ordered = lines.repartition("nation", "part").sortWithinPartitions("nation", "part", "c_custkey")
    writer = ordered.select("nation", "part", "value").write.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    writer.partitionBy("nation", "part").text(path)
    return path


def raw_folders(spark: SparkSession, root: str, t: Callable[[str], DataFrame]) -> tuple[str, str]:
    """Raw series files and the yearly context document, written from the tables.

    Line items are observations of their supplier (quarter of the ship date,
    ``-`` for a price without discount), suppliers are series, nations and
    regions the code tables; the context counts orders by nation and year.
    """
    series, context = f"{root}/series", f"{root}/context"
    pad = lambda c: F.concat(c.cast("string"), F.lit("   "))
    text = lambda v: F.lit(v).cast("string")

    def put(df: DataFrame, name: str) -> None:
        df.write.option("header", True).option("sep", "\t").option("emptyValue", "").csv(f"{series}/{name}")

    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    obs = t("lineitem").select(
        pad(F.concat(F.lit("PRS"), F.col("l_suppkey"))).alias("series_id"), F.year("l_shipdate").cast("string").alias("year"),
        F.concat(F.lit("Q0"), F.quarter("l_shipdate").cast("string")).alias("period"),
        F.when(F.col("l_discount") == 0, "-").otherwise(price).alias("value"), text("").alias("footnote_codes"),
    )
    put(obs, "pr.data.1.AllData")
    put(obs.filter("period = 'Q04'"), "pr.data.0.Current")
    nation, region = t("nation"), t("region")
    owner = t("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    put(owner.select(
        pad(F.concat(F.lit("PRS"), F.col("s_suppkey"))).alias("series_id"), pad(F.col("s_nationkey")).alias("sector_code"),
        pad(F.col("n_regionkey")).alias("class_code"), pad(F.col("n_regionkey")).alias("measure_code"),
        F.when(F.col("s_acctbal") < 0, "0").otherwise("1").alias("duration_code"), text("S").alias("seasonal"), text("-").alias("base_year"),
        text("").alias("footnote_codes"), text("1992").alias("begin_year"), text("Q01").alias("begin_period"),
        text("1998").alias("end_year"), text("Q04").alias("end_period"),
    ), "pr.series")

    def codes(df: DataFrame, code: Column, label: Column, names: tuple[str, str], file: str) -> None:
        put(df.select(pad(code).alias(names[0]), label.alias(names[1]), text("0").alias("display_level"),
                      text("T").alias("selectable"), text("1").alias("sort_sequence")), file)

    codes(nation, F.col("n_nationkey"), F.col("n_name"), ("sector_code", "sector_name"), "pr.sector")
    codes(region, F.col("r_regionkey"), F.concat(F.lit("class "), F.col("r_regionkey")), ("class_code", "class_text"), "pr.class")
    codes(region, F.col("r_regionkey"), F.col("r_name"), ("measure_code", "measure_text"), "pr.measure")
    spans = spark.createDataFrame([("0", "short"), ("1", "long")], "code string, label string")
    codes(spans, F.col("code"), F.col("label"), ("duration_code", "duration_text"), "pr.duration")
    put(spark.createDataFrame([("S", "adjusted"), ("U", "not adjusted")], "seasonal_code string, seasonal_text string"), "pr.seasonal")
    put(spark.createDataFrame([(f"Q0{q}", f"QTR{q}", f"{q}. quarter") for q in range(1, 5)], "period string, period_abbr string, period_name string"), "pr.period")
    put(spark.createDataFrame([("R", "revised")], "footnote_code string, footnote_text string"), "pr.footnote")

    home = t("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    yearly = t("orders").join(home, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name", F.year("o_orderdate").alias("y")).count()
    record = F.struct(F.lit("0").alias("Nation ID"), F.col("n_name").alias("Nation"), F.col("y").alias("Year"), F.col("count").alias("Population"))
    # nations times years, a fixed number of records
    whole = yearly.agg(F.to_json(F.struct(F.array(F.lit("Year")).alias("columns"), F.collect_list(record).alias("data"))).alias("value"))
    whole.coalesce(1).write.text(f"{context}/population.json")
    return series, context
