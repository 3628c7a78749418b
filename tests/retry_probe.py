"""Run queries with failing first task attempts; print whether results equal a clean run.

Executed in its own process (a Spark master that allows task retries), by
tests/test_retries.py. The failure injection wraps the *input* only; the
library plans are unchanged.
"""

import json
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.operators.latest import latest_by_key  # noqa: E402
from strata.plans import derived, gold  # noqa: E402
from strata.operators.changes import classify_changes  # noqa: E402
from strata.plans.manifest import latest_success  # noqa: E402


def flaky(df):
    """Same rows, but the first attempt of every even partition raises (a lost task)."""

    def fail_first(batches):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        yield from batches

    return df.mapInArrow(fail_first, df.schema)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def main(sf_dir: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")  # up to 4 attempts per task
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "6")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    t = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet").repartition(4)
    orders, customer, nation, region, events = t("orders"), t("customer"), t("nation"), t("region"), t("events")

    def queries(o, e):
        best = gold.best_year_by_customer(o, customer, nation, region)
        latest = latest_by_key(e, ["event_type", "user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
        prev = latest_success(derived.previous_log(o), ["k"], version_col="m")
        changes = classify_changes(derived.current_listing(o), prev, ["k"], ["sz", "m"]).select("k", "action")
        return {"best_year": best, "latest_state": latest, "changes": changes}

    clean = {k: rows(v) for k, v in queries(orders, events).items()}
    retried = {k: rows(v) for k, v in queries(flaky(orders), flaky(events)).items()}
    print(json.dumps({k: clean[k] == retried[k] and len(clean[k]) > 0 for k in clean}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
