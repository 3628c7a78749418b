"""Reading the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table as a lazy parquet scan (filters and projections reach the reader).

    The files are listed at each call, so a table rewritten in place is seen.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
