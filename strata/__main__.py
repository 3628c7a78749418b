"""Command line: ``python -m strata {medallion,ingest} ...`` (or via spark-submit).

medallion  raw files -> bronze, silver, gold tables; prints per-rule drop counts
ingest     listing pages + landed folder -> one incremental step on the log table;
           prints the action histogram
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.plans.manifest import incremental_ingest
from strata.plans.medallion import run_medallion
from strata.session import apply_defaults, local_session, use_measured_broadcast
from strata.sources.landed import read_landed
from strata.sources.listing import parse_listing


def _session(args) -> SparkSession:
    if args.local:
        return local_session("*")
    spark = apply_defaults(SparkSession.builder.appName("strata").getOrCreate())
    return use_measured_broadcast(spark) if args.measured_broadcast else spark


def _medallion(spark: SparkSession, args) -> dict:
    result = run_medallion(
        spark,
        args.series_root,
        args.context_root,
        database=args.database,
        nation=args.nation,
        series_id=args.series_id,
        period=args.period,
        years=(args.first_year, args.last_year),
        exact_sums=args.exact_sums,
        reject_nan=args.reject_nan,
        trim_before_gate=args.trim_before_gate,
        reject_extra_fields=args.reject_extra_fields,
        series_buckets=args.series_buckets,
    )
    return {"tables": sorted(result.tables), "quality": result.quality}


def _ingest(spark: SparkSession, args) -> dict:
    pages = spark.read.text(args.listing, wholetext=True)
    inventory = parse_listing(pages, "value", args.base_url, args.prefix)
    landed = read_landed(spark, args.landed_dir).select("file_name", "relative_path", "length", "modification_time")
    now = datetime.fromisoformat(args.now) if args.now else None
    counts = incremental_ingest(
        spark, inventory, landed, args.log_table, args.source, args.landed_dir, now,
        reappeared=args.reappeared, state_table=args.state_table, run_id=args.run_id,
    )
    return {row["action"]: row["n"] for row in counts.orderBy(F.col("action")).collect()}


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="strata")
    parser.add_argument("--local", action="store_true", help="run on a local session (tests, laptops)")
    parser.add_argument(
        "--measured-broadcast", action="store_true", help="broadcast only sides whose measured size is small"
    )
    sub = parser.add_subparsers(dest="command", required=True)

    m = sub.add_parser("medallion", help="publish bronze, silver and gold tables")
    m.add_argument("--series-root", required=True, help="folder with the tab-separated series files")
    m.add_argument("--context-root", required=True, help="folder with the yearly context JSON document")
    m.add_argument("--database", default="default")
    m.add_argument("--nation", default="United States")
    m.add_argument("--series-id", default="PRS30006032")
    m.add_argument("--period", default="Q01")
    m.add_argument("--first-year", type=int, default=2013)
    m.add_argument("--last-year", type=int, default=2018)

    m.add_argument("--exact-sums", action="store_true", help="rank years by exact decimal sums")
    m.add_argument("--reject-nan", action="store_true", help="drop and count NaN observations")
    m.add_argument("--trim-before-gate", action="store_true", help="trim the nation before it is compared")

    m.add_argument("--reject-extra-fields", action="store_true", help="drop and count observation lines of too many fields")
    m.add_argument("--series-buckets", type=int, default=None, help="deal observations and series into buckets by series")

    i = sub.add_parser("ingest", help="one incremental landing step against the log table")
    i.add_argument("--listing", required=True, help="listing page file(s), read whole")
    i.add_argument("--base-url", required=True)
    i.add_argument("--prefix", default="pr.")
    i.add_argument("--landed-dir", required=True)
    i.add_argument("--log-table", required=True)
    i.add_argument("--source", required=True)
    i.add_argument("--now", default=None, help="ingestion time (ISO); default: current time")
    i.add_argument("--reappeared", action="store_true", help="re-land removed files that come back unchanged")
    i.add_argument("--state-table", default=None, help="keep a compacted log here; runs read it, not the history")

    i.add_argument("--run-id", default=None, help="id of the job run: repeated after its commit it writes nothing")

    args = parser.parse_args(argv)
    spark = _session(args)
    out = _medallion(spark, args) if args.command == "medallion" else _ingest(spark, args)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
