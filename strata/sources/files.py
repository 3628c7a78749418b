"""Files of a folder tree: a listing that sees empty files, and digests by byte ranges.

Spark's own file scan passes zero-byte files by and reads a binary file as one
row. Here tasks list folders and read ranges themselves, through the file
system that the folder's address names.
"""

from __future__ import annotations

import fnmatch
import hashlib
import posixpath
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import materialize

FOUND = "file_path string, relative_path string, is_folder boolean, length long, modification_time timestamp"
#: Names that Spark's readers pass by as well.
HIDDEN = ("_", ".")
RANGE_BYTES = 64 << 20
#: Bytes read at once.
STEP = 4 << 20


def opened(address: str) -> tuple[arrow_fs.FileSystem, str, str]:
    """(file system, path in it, what an address has before the path) of a folder or file address."""
    if "://" not in address and not address.startswith("file:"):
        return arrow_fs.LocalFileSystem(), address, "file:"
    if urlsplit(address).scheme == "file":
        return arrow_fs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/"), "file:"
    system, path = arrow_fs.FileSystem.from_uri(address)
    return system, path, address[: len(address.rstrip("/")) - len(path.rstrip("/"))]


def frame_of(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    """Rows as columns of plain objects, which Spark casts to its own types, also where there are none."""
    values = list(zip(*rows)) if rows else [()] * len(columns)
    return pd.DataFrame({c: pd.Series(list(v), dtype=object) for c, v in zip(columns, values)})


def list_files(spark: SparkSession, root: str, glob: str | None = None, *, recursive: bool = True) -> DataFrame:
    """``(file_path, relative_path, file_name, length, modification_time)`` of every file below ``root``, empty ones too.

    One job a level of folders: its folders are spread over the tasks, each task
    lists its own, so neither a level nor the tree passes the driver. ``glob``
    filters names (``*``, ``?``, ``[...]``). Files and folders whose names start
    with ``_`` or ``.`` are passed by, as by Spark's readers. A missing or empty
    root has no files. Executors must reach the root (a local path is only for
    local sessions).
    """
    base = root.rstrip("/") or "/"

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path, before = opened(base)
        for frame in frames:
            for folder in frame["relative_path"]:
                inside = posixpath.join(path, folder)
                rows = []
                for info in system.get_file_info(arrow_fs.FileSelector(inside, allow_not_found=True)):
                    if info.base_name.startswith(HIDDEN) or info.type == arrow_fs.FileType.NotFound:
                        continue
                    under = posixpath.join(folder, info.base_name)
                    is_folder = info.type == arrow_fs.FileType.Directory
                    if is_folder or glob is None or fnmatch.fnmatchcase(info.base_name, glob):
                        rows.append((before + posixpath.join(path, under), under, is_folder, None if is_folder else info.size, info.mtime))
                out = frame_of(rows, ["file_path", "relative_path", "is_folder", "length", "modification_time"])
                out["modification_time"] = pd.to_datetime(out["modification_time"], utc=True).dt.tz_localize(None).astype("datetime64[us]")
                yield out

    files, folders = None, spark.createDataFrame([("",)], "relative_path string")
    while True:
        # milliseconds, as in Spark's own listing; kept, as a folder may change between two readings
        level = materialize(folders.select("relative_path").mapInPandas(look, FOUND).withColumn(
            "modification_time", F.date_trunc("MILLISECOND", "modification_time")
        ))
        own = level.filter(~F.col("is_folder"))
        files = own if files is None else files.unionByName(own)
        folders = level.filter("is_folder")
        if not recursive or folders.isEmpty():
            break
        folders = folders.repartition("relative_path")
    return files.select(
        "file_path", "relative_path", F.element_at(F.split("relative_path", "/"), -1).alias("file_name"), "length", "modification_time"
    )


def range_digests(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file_path, range_no, range_length, range_sha256)``: a row for each ``range_bytes`` of every file.

    Ranges are dealt over the tasks by file and number and read in steps of a few
    MB, so neither a file nor a range has to fit in memory. An empty file has one
    empty range.
    """
    last = F.greatest(F.ceil(F.col("length") / range_bytes), F.lit(1)) - 1
    ranges = files.select("file_path", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("range_no"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for address, number in zip(frame["file_path"], frame["range_no"]):
                system, path, _ = opened(address)
                digest, left, seen = hashlib.sha256(), range_bytes, 0
                with system.open_input_file(path) as file:
                    file.seek(number * range_bytes)
                    while left and (data := file.read(min(left, STEP))):
                        digest.update(data)
                        left, seen = left - len(data), seen + len(data)
                rows.append((address, number, seen, digest.hexdigest()))
            yield frame_of(rows, ["file_path", "range_no", "range_length", "range_sha256"])

    return ranges.repartition("file_path", "range_no").mapInPandas(
        read, "file_path string, range_no long, range_length long, range_sha256 string"
    )


def tree_digests(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file_path, length, tree_sha256)``: the digest of each file's range digests in order (64 letters a range).

    Equal trees of one ``range_bytes`` stand for equal bytes, whatever the size of
    a file; a file's ranges meet as one digest each.
    """
    whole = range_digests(files, range_bytes).groupBy("file_path").agg(
        F.array_sort(F.collect_list(F.struct("range_no", "range_sha256"))).alias("r"), F.sum("range_length").alias("length")
    )
    return whole.select("file_path", "length", F.sha2(F.concat_ws("", F.col("r.range_sha256")), 256).alias("tree_sha256"))


def changed_ranges(current: DataFrame, previous: DataFrame, keys: tuple[str, ...] = ("file_path",)) -> DataFrame:
    """Ranges of ``range_digests`` that are NEW, CHANGED, UNCHANGED or REMOVED against an earlier reading."""
    now = current.select(*keys, "range_no", "range_length", F.col("range_sha256").alias("now"))
    then = previous.select(*keys, "range_no", F.col("range_sha256").alias("then"))
    action = (
        F.when(F.col("then").isNull(), "NEW").when(F.col("now").isNull(), "REMOVED")
        .when(F.col("now") == F.col("then"), "UNCHANGED").otherwise("CHANGED")
    )
    return now.join(then, [*keys, "range_no"], "full").select(*keys, "range_no", "range_length", action.alias("action"))
