"""One large JSON document read by many tasks.

The document is an object with an array of records. It is cut into blocks of
bytes. A first pass over the blocks works out, for each way a block can begin
(between values, inside a string, after a backslash inside one), how it ends
and how the depth changes; combined in order this gives every block its true
beginning. A second pass finds the record array, a third reads the records that
begin in each block, past its end where the last one needs it.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from strata.operators.cleanse import sanitize_columns
from strata.session import materialize
from strata.sources.files import frame_of, list_files, opened

BLOCK_BYTES = 16 << 20
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2

# A string, to its quote or to the end of the block (then perhaps behind a backslash); or a bracket.
_TOKEN = re.compile(rb'"(?:[^"\\]++|\\.)*+(?:"|(\\?)\Z)|[{}\[\]]', re.S)
# What is left of a string that began before the block.
_REST = re.compile(rb'(?:[^"\\]++|\\.)*+(?:"|(\\?)\Z)', re.S)


def tokens(block: bytes, start: int) -> Iterator[tuple[int, int, int]]:
    """(place, end, kind) of brackets and strings from a beginning; at last (len, len, state of the end).

    ``kind`` is the byte of a bracket, or ``"`` for a string that ends in the block.
    """
    at, state = (1 if start == ESCAPED and block else 0), OUTSIDE
    if start != OUTSIDE and not block:
        state = start
    elif start != OUTSIDE:
        rest = _REST.match(block, at)
        at = rest.end()
        if rest[1] is not None:
            state = ESCAPED if rest[1] else INSIDE
    if state == OUTSIDE:
        for token in _TOKEN.finditer(block, at):
            if token[1] is not None:
                state = ESCAPED if token[1] else INSIDE
                break
            yield token.start(), token.end(), block[token.start()]
    yield len(block), len(block), state


@dataclass
class Ending:
    """How a block ends for each of its three beginnings: state, and change of depth."""

    state: tuple[int, int, int]
    depth: tuple[int, int, int]

    @classmethod
    def of(cls, block: bytes) -> Ending:
        ends = []
        for start in (OUTSIDE, INSIDE, ESCAPED):
            depth, state = 0, OUTSIDE
            for place, _, kind in tokens(block, start):
                if place == len(block):
                    state = kind
                elif kind in b"{[":
                    depth += 1
                elif kind in b"}]":
                    depth -= 1
            ends.append((state, depth))
        return cls(tuple(s for s, _ in ends), tuple(d for _, d in ends))


def marks(block: bytes, start: int, depth: int) -> Iterator[tuple[int, str, str]]:
    """(place, kind, text) of what stands directly in the outermost object: strings, and where arrays open and close."""
    for place, end, kind in tokens(block, start):
        if place == len(block):
            return
        if kind == ord('"'):
            if depth == 1:
                yield place, "string", block[place + 1 : end - 1].decode("utf-8", "replace")
        elif kind in b"{[":
            if depth == 1 and kind == ord("["):
                yield place, "open", ""
            depth += 1
        else:
            depth -= 1
            if depth == 1 and kind == ord("]"):
                yield place, "close", ""


def _read(address: str, start: int, size: int) -> bytes:
    system, path, _ = opened(address)
    with system.open_input_file(path) as file:
        file.seek(start)
        return file.read(size)


def _blocks(spark: SparkSession, path: str, block_bytes: int) -> DataFrame:
    system, inside, _ = opened(path)
    if system.get_file_info(inside).type == FileType.File:
        parent, name = posixpath.split(path.rstrip("/"))
        files = list_files(spark, parent or "/", recursive=False).filter(F.col("file_name") == name)
    else:
        files = list_files(spark, path)
    last = F.greatest(F.ceil(F.col("length") / block_bytes), F.lit(1)) - 1
    return files.select("file_path", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("block")).repartition("file_path", "block")


def read_split_records(
    spark: SparkSession, path: str, schema: StructType, array_col: str = "data", *, block_bytes: int = BLOCK_BYTES, keep_path: bool = False
) -> DataFrame:
    """The rows of ``read_json_records``, with every document spread over tasks by blocks of ``block_bytes``.

    ``path`` is a file or a folder of files, one JSON object each (UTF-8), whose
    ``array_col`` holds an array of objects directly in the object; other columns
    of the document are not read. A document is read three times, its
    blocks side by side; per block the driver and the windows hold a few numbers.
    The last array of that name counts, as in Spark's reader. NULLs and nested
    arrays in the array give no row. Documents must be well formed:
    where one is not, the rows up to its fault may still come.
    """
    blocks = _blocks(spark, path, block_bytes)

    def ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for address, number in zip(frame["file_path"], frame["block"]):
                ending = Ending.of(_read(address, number * block_bytes, block_bytes))
                rows.append((address, number, list(ending.state), list(ending.depth)))
            yield frame_of(rows, ["file_path", "block", "state", "depth"])

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        """Every block's beginning, from the endings of those before it."""
        state, depth, rows = OUTSIDE, 0, []
        ordered = frame.sort_values("block")
        for number, states, depths in zip(ordered["block"], ordered["state"], ordered["depth"]):
            rows.append((frame["file_path"].iat[0], number, state, depth))
            state, depth = int(states[state]), depth + int(depths[state])
        return frame_of(rows, ["file_path", "block", "start", "depth"])

    endings = blocks.mapInPandas(ends, "file_path string, block long, state array<int>, depth array<int>")
    begun = materialize(endings.groupBy("file_path").applyInPandas(combine, "file_path string, block long, start int, depth int"))

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for address, number, start, depth in zip(frame["file_path"], frame["block"], frame["start"], frame["depth"]):
                at = number * block_bytes
                found = marks(_read(address, at, block_bytes), start, depth)
                rows += [(address, at + place, kind, text) for place, kind, text in found]
            yield frame_of(rows, ["file_path", "place", "kind", "text"])

    def spans(frame: pd.DataFrame) -> pd.DataFrame:
        """Where the record array opens and closes; a key split between blocks is read as a whole below."""
        ordered = frame.sort_values("place")
        address, opens, key, at, rows = frame["file_path"].iat[0], None, None, 0, []
        for place, kind, text in zip(ordered["place"], ordered["kind"], ordered["text"]):
            if kind == "string":
                key = text
            elif kind == "open":
                # between the last string and the bracket stands its key, unless the key lies over a block's end
                before = _read(address, max(0, place - 4096), min(place, 4096))
                named = re.search(rb'"((?:[^"\\]|\\.)*)"\s*:\s*\Z', before, re.S)
                key = named[1].decode("utf-8", "replace") if named else key
                opens, at = place, key
            elif opens is not None:
                if at == array_col:
                    rows = [(address, opens, place)]
                opens = None
        return frame_of(rows, ["file_path", "opens", "closes"])

    places = begun.repartition("file_path", "block").mapInPandas(find, "file_path string, place long, kind string, text string")
    arrays = materialize(places.groupBy("file_path").applyInPandas(spans, "file_path string, opens long, closes long"))
    inside = begun.join(arrays, "file_path").filter(
        (F.col("closes") >= F.col("block") * block_bytes) & (F.col("opens") < (F.col("block") + 1) * block_bytes)
    )

    def records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                found = block_records(row.file_path, row.block * block_bytes, row.start, row.depth, row.opens, row.closes, block_bytes)
                yield frame_of([(row.file_path, text) for text in found], ["file_path", "record"])

    texts = inside.repartition("file_path", "block").mapInPandas(records, "file_path string, record string")
    element = schema[array_col].dataType
    assert isinstance(element, ArrayType)
    # parsed once, inside a Generate node that no filter is pushed below
    parsed = texts.select("file_path", F.explode(F.array(F.from_json("record", element.elementType))).alias("__strata_rec"))
    keep: Iterable[str] = ["file_path"] if keep_path else []
    return sanitize_columns(parsed.select(*keep, "__strata_rec.*"))


def block_records(address: str, at: int, start: int, depth: int, opens: int, closes: int, block_bytes: int) -> Iterator[str]:
    """Texts of the records (objects directly in the array) that begin in the block at ``at``."""
    block = _read(address, at, block_bytes)
    began = None
    for place, end, kind in tokens(block, start):
        if place == len(block) or kind == ord('"'):
            continue
        if kind in b"{[":
            if depth == 2 and kind == ord("{") and opens < at + place < closes:
                began = place
            depth += 1
        else:
            depth -= 1
            if depth == 2 and began is not None:
                yield block[began:end].decode("utf-8", "replace")
                began = None
    if began is None:
        return
    # the last record goes on behind the block: read on, with what is read doubling, until it closes
    more = block_bytes
    while at + began + more < closes + block_bytes:
        more *= 2
        text = _read(address, at + began, more)
        level = 0
        for place, end, kind in tokens(text, OUTSIDE):
            if place == len(text) or kind == ord('"'):
                continue
            level += 1 if kind in b"{[" else -1
            if level == 0:
                yield text[:end].decode("utf-8", "replace")
                return
