"""Incremental landing of new raw files with Structured Streaming.

The streaming file source remembers which files it has processed (in the
checkpoint), so each run picks up only files it has not seen: the streaming
form of "land only NEW items". Every micro-batch writes its rows and one
log row per file; a batch re-run after a failure overwrites its own output
folder, so the result is exactly-once even though ``foreachBatch`` is
at-least-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.schemas import SUCCESS


def raw_file_stream(
    spark: SparkSession,
    raw_dir: str,
    schema: StructType,
    *,
    sep: str = "\t",
    header: bool = True,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming read of delimited files with the fixed schema plus file metadata columns."""
    reader = spark.readStream.schema(schema).option("header", str(header).lower()).option("sep", sep)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(raw_dir).select(
        *[F.col(f.name) for f in schema.fields],
        F.col("_metadata.file_path").alias("_file_path"),
        F.col("_metadata.file_name").alias("_file_name"),
        F.col("_metadata.file_size").alias("_file_size"),
        F.col("_metadata.file_modification_time").alias("_file_modified"),
    )


def _batch_writer(bronze_path: str, log_path: str, source: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.drop("_file_path", "_file_name", "_file_size", "_file_modified")
        rows.write.mode("overwrite").parquet(f"{bronze_path}/batch_id={batch_id}")
        files = batch.groupBy("_file_name", "_file_path", "_file_size", "_file_modified").agg(
            F.count(F.lit(1)).alias("rows")
        )
        records = files.select(
            F.lit(source).alias("source"),
            F.col("_file_name").alias("file_name"),
            F.col("_file_path").alias("file_path"),
            F.col("_file_size").alias("file_size"),
            F.col("_file_modified").alias("source_modified_time"),
            F.current_timestamp().alias("ingestion_time"),
            F.lit(SUCCESS).alias("status"),
            "rows",
        )
        records.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    return write


def land_new_files(
    spark: SparkSession,
    raw_dir: str,
    schema: StructType,
    bronze_path: str,
    log_path: str,
    checkpoint_location: str,
    source: str,
    **read_options,
) -> StreamingQuery:
    """Process every not-yet-seen file under ``raw_dir`` once, then stop
    (``availableNow``). Returns the query; call ``awaitTermination()``.

    ``checkpoint_location`` must be shared storage on a cluster.
    """
    stream = raw_file_stream(spark, raw_dir, schema, **read_options)
    return (
        stream.writeStream.foreachBatch(_batch_writer(bronze_path, log_path, source))
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
