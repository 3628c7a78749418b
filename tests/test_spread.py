"""Writes that keep many tasks busy: buckets of a state, and files of a partitioned folder."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from strata.plans import derived
from strata.plans.manifest import LOG_COLUMNS
from strata.plans.runs import BucketedState
from tests.conftest import RUN1, T1


def test_a_large_bucket_is_written_by_several_tasks(spark):
    values = {"source": F.lit("S"), "file_name": F.col("id").cast("string"), "file_path": F.lit("p"), "file_size": F.col("id"),
              "source_modified_time": F.lit(T1), "ingestion_time": F.lit(RUN1), "status": F.lit("SUCCESS"), "listed_size": F.col("id")}
    rows = spark.range(5000).select(*[values[c].alias(c) for c in LOG_COLUMNS])
    name = f"spread_{uuid.uuid4().hex[:8]}"
    state = BucketedState(spark, name, f"{name}_log", "S", 2)
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that tasks do not hang on their size
    try:
        state.write(rows, [0, 1], "a")
        kept = spark.read.table(name)
        files = kept.select("bucket", F.input_file_name().alias("f")).distinct().groupBy("bucket").agg(F.count("f").alias("n")).collect()
        assert len(files) == 2 and all(1 < r.n <= 8 for r in files)
        assert kept.count() == kept.select("file_name").distinct().count() == 5000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_tasks_move_their_own_files(spark, tmp_path, monkeypatch):
    seen, option = {}, DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, key, value: seen.update({key: value}) or option(self, key, value))
    customer = spark.createDataFrame([(k, k % 3, f"n{k}") for k in range(0, 5000, 7)], "c_custkey long, c_nationkey int, c_name string")
    path = derived.customer_files(str(tmp_path / "files"), customer)
    assert seen["mapreduce.fileoutputcommitter.algorithm.version"] == 2
    got = spark.read.text(path)
    assert got.count() == customer.count() and got.select("nation", "part").distinct().count() == 15
    assert not (tmp_path / "files" / "_temporary").exists()
