"""Files already landed in storage, as a table of metadata (and optionally digests)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import basename, content_hash
from strata.sources.files import list_files, opened

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def read_landed(spark: SparkSession, path: str, glob: str | None = None, *, with_hash: bool = False) -> DataFrame:
    """``(file_path, relative_path, file_name, length, modification_time[, content_sha256])`` per file.

    The listing sees zero-byte files, so an empty landing is a landing of length
    0. ``relative_path`` is the path below ``path``. Content is only read when
    ``with_hash`` is set; the hash is computed on the executors, a file as one row
    of Spark's binary reader, so a file must fit in executor memory and under
    ``spark.sql.sources.binaryFile.maxLength``. Larger files are compared by
    ``strata.sources.files.tree_digests``, which reads ranges.
    """
    files = list_files(spark, path, glob)
    if not with_hash:
        return files
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    read = reader.load(path).select(
        F.col("path").alias("file_path"), basename("path").alias("file_name"), "length",
        F.col("modificationTime").alias("modification_time"), content_hash("content").alias("content_sha256"),
    )
    # the scan has every file that is not empty, with the bytes it hashed; the listing adds the empty ones
    _, base, before = opened(path)
    skipped = len(before + base.rstrip("/")) + 1
    full = read.select("file_path", F.expr(f"substring(file_path, {skipped + 1})").alias("relative_path"), *read.columns[1:])
    empty = files.filter("length = 0").withColumn("content_sha256", F.lit(EMPTY_SHA256))
    return full.unionByName(empty)
