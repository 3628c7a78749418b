"""Repeated passages by hashes of windows, prefiltered on a difference cover.

No suffix is ordered by its bytes: equal strings are told by their names, which
are hashes, and matches are not checked on the bytes (README: false matches).

Suffixes matter up to ``width`` bytes only. For any two positions there is a
shift below ``PERIOD`` at which both fall on the difference cover, so two equal
strings of ``width`` bytes hold two equal cover windows of
``width - PERIOD + 1`` bytes at the same shift. The job therefore

1. names the cover windows and sorts the names, one bucket of the name space
   at a time: a window's rank class is shared or single;
2. names only the suffixes that hold a shared cover window, and sorts these
   names bucket by bucket, to learn which also start in an earlier document;
3. removes the bytes that such suffixes cover.

Documents travel once, in compressed chunks of a range of ids. A chunk sends a
bucket its sorted distinct names (differences, byte planes, compressed) and
gets one bit per name back, so a passage in very many documents is one name per
chunk. Chunks are cut by bytes, and rows without an id pass them by, so only a
single text of more than a chunk makes a larger one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from strata.llm.common import checkpointed, fresh, parallelism, release, with_package
from strata.llm.kernels import mix64

PERIOD = 21
#: A perfect difference set modulo 21: every remainder is a difference of two of its members.
COVER = (0, 1, 4, 14, 16)
CHUNK_BYTES = 4 << 20
#: Text whose windows are named at once; its arrays take about 60 times that.
SLICE_BYTES = 1 << 18
#: Names that are sorted at once; more are sorted range by range, so that arrays beside the names stay small.
SORT_NAMES = 1 << 18
#: Chunks, handled one by one, that share a partition where that makes more partitions than Spark is set to.
TASK_CHUNKS = 32
#: Names that one bucket task sorts, about.
BUCKET_NAMES = 1_500_000
#: Suffix names; one bit short of a word, so that bucket bounds fit into one.
NAME_BITS = 63
_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(23).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)

_REQUEST = StructType([StructField("bucket", IntegerType()), StructField("chunk", IntegerType()), StructField("names", BinaryType())])
_REPLY = StructType([
    StructField("chunk", IntegerType()), StructField("kind", IntegerType()), StructField("bucket", IntegerType()),
    StructField("num", LongType()), StructField("bits", BinaryType()),
])
COPY, SHARED, EARLIER = 0, 1, 2


def compressed(data, level: int = 1) -> bytes:
    return pa.Codec("zstd", compression_level=level).compress(data, asbytes=True)


def decompressed(data: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(data, size, asbytes=True)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, from 0 to ``size`` - 1."""
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, x, np.uint64)], dtype=np.uint64) for x in (_BASE, inverse))


class Names:
    """64-bit names of windows of one run of bytes: polynomial hashes from running sums."""

    def __init__(self, buf: np.ndarray):
        power, self.inverse = _powers(1 << max(SLICE_BYTES.bit_length(), len(buf).bit_length()))
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.multiply(_BYTE[buf], power[: len(buf)], out=self.sums[1:])
        np.cumsum(self.sums[1:], out=self.sums[1:])

    def at(self, start: np.ndarray, width: int) -> np.ndarray:
        return mix64((self.sums[start + width] - self.sums[start]) * self.inverse[start])


def ranges(name: np.ndarray) -> Iterator[np.ndarray]:
    """Where the names of each range lie, ranges in order, of about ``SORT_NAMES`` names each (names are hashes)."""
    parts = -(-len(name) // SORT_NAMES)
    if parts <= 1:
        yield np.arange(len(name))
        return
    step = int(name.max()) // parts + 1
    part = (name // np.uint64(step)).astype(np.int32)
    for k in range(parts):
        yield np.flatnonzero(part == k)


def distinct(name: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names with the smallest and largest rank of each."""
    found = [_distinct(name[at], rank[at]) for at in ranges(name)]
    return tuple(np.concatenate(x) for x in zip(*found))


def _distinct(name: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(name):
        return name, rank, rank
    room = int(rank.max()).bit_length()
    if int(name.max()).bit_length() + room <= 64:  # both in one word, which sorts fastest
        both = np.sort((name << np.uint64(room)) | rank.astype(np.uint64))
        name, rank = both >> np.uint64(room), (both & np.uint64((1 << room) - 1)).astype(np.int32)
    else:
        order = np.lexsort((rank, name))
        name, rank = name[order], rank[order]
    fresh_name = name[1:] != name[:-1]
    first, last = np.flatnonzero(np.r_[True, fresh_name]), np.flatnonzero(np.r_[fresh_name, True])
    return name[first], rank[first], rank[last]


def packed(names: np.ndarray) -> bytes:
    """Sorted distinct numbers as compressed byte planes of their differences."""
    step = np.diff(names, prepend=np.uint64(0)).astype("<u8")
    planes = max(1, (int(step.max(initial=0)).bit_length() + 7) // 8)
    data = np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()
    return bytes([planes]) + len(names).to_bytes(4, "little") + compressed(data)


def unpacked(data: bytes) -> np.ndarray:
    planes, n = data[0], int.from_bytes(data[1:5], "little")
    step = np.zeros((n, 8), np.uint8)
    if n:
        step[:, :planes] = np.frombuffer(decompressed(data[5:], n * planes), np.uint8).reshape(planes, n).T
    return np.cumsum(step.view("<u8").ravel(), dtype=np.uint64)


class Chunk:
    """The documents of one range of ids, their names, and what buckets have said of them."""

    def __init__(self, docs: pa.Table, told: pa.Table, width: int, bits: int, buckets: int):
        self.docs, self.width, self.bits, self.buckets = docs, width, bits, buckets
        self.step = -(-(1 << bits) // buckets)
        self.wide = -(-(1 << NAME_BITS) // buckets)
        kind = np.asarray(told.column("kind"))
        copies = np.asarray(told.column("num"))[kind == COPY]
        ids = docs.column("doc_id").combine_chunks()
        self.texts = docs.column("text").cast(pa.binary()).to_pylist()
        self.known = ~np.asarray(pc.is_null(ids))
        number = np.asarray(pc.fill_null(ids, 0))
        self.copy = np.isin(number, copies) & self.known
        self.rank = np.unique(number, return_inverse=True)[1].astype(np.int32)
        self.told = {(int(k), int(b)): v for k, b, v in zip(kind, told.column("bucket").to_pylist(), told.column("bits").to_pylist()) if k != COPY}

    def slices(self) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Runs of documents that take part: row numbers, their bytes in one run, and where each begins (and the last ends)."""
        rows: list[int] = []
        held = 0
        use = [i for i, t in enumerate(self.texts) if t is not None and len(t) >= self.width and self.known[i] and not self.copy[i]]
        for i in [*use, None]:
            if rows and (i is None or held + len(self.texts[i]) > SLICE_BYTES):
                data = [self.texts[r] for r in rows]
                yield rows, np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
                rows, held = [], 0
            if i is not None:
                rows.append(i)
                held += len(self.texts[i])

    def _cover(self, names: Names, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions on the cover whose window lies in its document, the document's place in the slice, and short names."""
        size = self.width - PERIOD + 1
        room = np.diff(begin) - size + 1  # starts of whole windows in each document
        periods = np.arange(-(-int(room.max(initial=0)) // PERIOD))
        inside = (periods[:, None] * PERIOD + np.array(COVER)).ravel()
        count = np.searchsorted(inside, np.maximum(room, 0))
        which = np.repeat(np.arange(len(room)), count)
        turn = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        at = begin[which] + inside[turn]
        return at, which, names.at(at, size) >> np.uint64(64 - self.bits)

    def cover_names(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct cover names, and whether several documents of this chunk hold them."""
        name, low, high = distinct(*_joined(
            [(name, self.rank[rows][which]) for rows, buf, begin in self.slices() for _, which, name in [self._cover(Names(buf), begin)]]
        ))
        return name, low != high

    def _said(self, kind: int, names: np.ndarray, step: int) -> np.ndarray:
        """The bit that the buckets gave each name (0 where a bucket said nothing)."""
        out = np.zeros(len(names), bool)
        for (k, b), bits in self.told.items():
            if k == kind:
                a, z = self._span(names, b, step)
                out[a:z] = np.unpackbits(np.frombuffer(bits, np.uint8), count=z - a).astype(bool)
        return out

    @staticmethod
    def _span(names: np.ndarray, bucket: int, step: int) -> tuple[int, int]:
        low, high = bucket * step, (bucket + 1) * step
        a = int(np.searchsorted(names, np.uint64(low)))
        return a, len(names) if high > 1 << NAME_BITS else int(np.searchsorted(names, np.uint64(high)))

    def requests(self, chunk: int, names: np.ndarray, step: int) -> pa.Table:
        buckets, data = [], []
        for b in np.unique(names // np.uint64(step)).tolist() if len(names) else []:
            a, z = self._span(names, b, step)
            buckets.append(b)
            data.append(packed(names[a:z] - np.uint64(b * step)))
        return pa.table(
            [pa.array(buckets, pa.int32()), pa.array([chunk] * len(buckets), pa.int32()), pa.array(data, pa.binary())], names=_REQUEST.names
        )

    def suffixes(self) -> Iterator[tuple]:
        """Per slice the suffixes that hold a shared cover window: positions, names, ranks."""
        short, several = self.cover_names()
        shared = short[several | self._said(SHARED, short, self.step)]
        for rows, buf, begin in self.slices():
            names = Names(buf)
            at, which, name = self._cover(names, begin)
            hit = np.zeros(len(at), bool)
            if len(shared):
                hit = shared[np.minimum(np.searchsorted(shared, name), len(shared) - 1)] == name
            at, which = at[hit], which[hit]
            # a suffix up to PERIOD - 1 bytes before a shared window holds it
            turns = np.bincount(np.maximum(at - PERIOD + 1, begin[which]), minlength=len(buf) + 1) - np.bincount(at + 1, minlength=len(buf) + 1)
            pos = np.flatnonzero(np.cumsum(turns[:-1]) > 0)
            which = np.searchsorted(begin, pos, "right") - 1
            whole = pos + self.width <= begin[which + 1]
            pos, which = pos[whole], which[whole]
            yield rows, buf, begin, pos.astype(np.int32), names.at(pos, self.width) >> np.uint64(64 - NAME_BITS), self.rank[rows][which]

    def suffix_names(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct names of those suffixes and the smallest document rank of each."""
        name, low, _ = distinct(*_joined([(name, rank) for *_, name, rank in self.suffixes()]))
        return name, low

    def kept(self) -> tuple[list[int], list[int], list[bytes]]:
        """Per document: removed bytes, removed runs, and the bytes that stay."""
        removed, spans = [0] * len(self.texts), [0] * len(self.texts)
        out = [t or b"" for t in self.texts]
        for i in np.flatnonzero(self.copy).tolist():
            if len(out[i]) >= self.width:  # the whole text starts in a smaller document
                removed[i], spans[i], out[i] = len(out[i]), 1, b""
        found = list(self.suffixes())
        names, low, _ = distinct(*_joined([(name, rank) for *_, name, rank in found]))
        early = self._said(EARLIER, names, self.wide)
        for rows, buf, begin, pos, name, rank in found:
            at = np.searchsorted(names, name)
            gone = pos[early[at] | (rank > low[at])] if len(pos) else pos
            if not len(gone):
                continue
            turns = np.bincount(gone, minlength=len(buf) + 1) - np.bincount(gone + self.width, minlength=len(buf) + 1)
            cover = np.cumsum(turns[:-1]) > 0
            for k, r in enumerate(rows):
                own = cover[begin[k] : begin[k + 1]]
                if own.any():
                    removed[r] = int(own.sum())
                    spans[r] = int(own[0]) + int((own[1:] & ~own[:-1]).sum())
                    out[r] = buf[begin[k] : begin[k + 1]][~own].tobytes()
        return removed, spans, out


def _joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    names, ranks = zip(*found) if found else ([], [])
    return np.concatenate([np.zeros(0, np.uint64), *names]), np.concatenate([np.zeros(0, np.int32), *ranks])


def _flags(kind: int, name: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each name whether another chunk has it, or one of smaller order."""
    if not len(name):
        return np.zeros(0, bool)
    order = np.lexsort((owner, name)) if kind == EARLIER else np.argsort(name)
    name, owner = name[order], owner[order]
    fresh_name = np.r_[True, name[1:] != name[:-1]]
    flag = np.zeros(len(name), bool)
    if kind == EARLIER:
        flag[order] = owner > owner[np.flatnonzero(fresh_name)[np.cumsum(fresh_name) - 1]]
    else:
        flag[order] = ~(fresh_name & np.r_[fresh_name[1:], True])
    return flag


def _bucket_reply(kind: int, place: np.ndarray):
    """Sort one bucket's names of all chunks and answer each chunk with one bit per name.

    ``place`` has each chunk's order; chunks of one large id share theirs.
    """

    def run(table: pa.Table) -> pa.Table:
        chunk = np.asarray(table.column("chunk"))
        lists = [unpacked(x) for x in table.column("names").to_pylist()]
        size = np.array([len(x) for x in lists])
        name, owner = np.concatenate(lists), np.repeat(place[chunk], size)
        del lists
        flag = np.zeros(len(name), bool)
        for part in ranges(name):
            flag[part] = _flags(kind, name[part], owner[part])
        at = np.r_[0, np.cumsum(size)]
        rows = [(int(c), np.packbits(flag[a:z]).tobytes()) for c, a, z in zip(chunk, at, at[1:]) if flag[a:z].any()]
        bucket = table.column("bucket")[0].as_py()
        n = len(rows)
        return pa.table([
            pa.array([c for c, _ in rows], pa.int32()), pa.array([kind] * n, pa.int32()), pa.array([bucket] * n, pa.int32()),
            pa.array([0] * n, pa.int64()), pa.array([b for _, b in rows], pa.binary()),
        ], names=_REPLY.names)

    return run


class Dealer:
    """Chunks of ids: ranges between bounds, of which one that holds a single large id may be several chunks.

    Chunks of one range have the same ``order``: they hold no documents that are
    earlier than one another's.
    """

    def __init__(self, bounds: np.ndarray, parts: dict[int, int]):
        self.bounds = np.unique(np.array([*bounds.tolist(), *(x for i in parts for x in (i, i + 1) if x < 1 << 63)], np.int64))
        count = np.ones(len(self.bounds) + 1, np.int64)
        for i, n in parts.items():
            count[self.range_of(np.array([i]))[0]] = n
        self.first = np.r_[0, np.cumsum(count)].astype(np.int32)
        self.order = np.repeat(np.arange(len(count), dtype=np.int32), count)

    def range_of(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, ids, "right")

    def chunk(self, ids: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """Chunk of each id; ``turn`` deals the rows of a large id."""
        at = self.range_of(ids)
        return (self.first[at] + turn % (self.first[at + 1] - self.first[at])).astype(np.int32)

    def chunks(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All chunks that may hold rows of each id, and the place of the id."""
        at = self.range_of(ids)
        count = self.first[at + 1] - self.first[at]
        which = np.repeat(np.arange(len(ids)), count)
        return (self.first[at][which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32), which


def _bounds(ids: DataFrame, count: int) -> np.ndarray:
    """Ids that cut a table into about ``count`` chunks of as many rows.

    Quantiles of quantiles: about the root of ``count`` (at least 2) wide ranges
    first, then as many cuts inside each, so no sketch and no task holds more
    than a small multiple of that root. The driver gets the bounds alone, 8 bytes a chunk.
    """
    wide = math.isqrt(count - 1) + 1
    narrow = max(2, -(-count // wide))
    cuts = lambda n: F.percentile_approx("doc_id", [i / n for i in range(1, n)], 50 * n)
    outer = np.unique(np.array(ids.agg(cuts(wide)).first()[0] or [], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(outer, np.asarray(batch.column("doc_id")), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(at)], names=["doc_id", "range"])

    inner = ids.mapInArrow(run, "doc_id long, range int").groupBy("range").agg(cuts(narrow).alias("cuts")).select("cuts").collect()
    return np.unique(np.array([*outer.tolist(), *(x for r in inner for x in r["cuts"])], np.int64))


def dealer(rows: DataFrame, total: int, chunk_bytes: int) -> Dealer:
    """Chunks of about ``chunk_bytes`` of text each, of rows doc_id (no nulls) and text.

    Bounds are quantiles of bytes: a row counts as often as the running sum of
    its task passes a multiple of a 256th of a chunk, from a start of the task's
    own. An id whose rows hold more than a chunk does not count there; it is a
    range of its own, dealt by chance to twice as many chunks as it fills. Only a single text can make a chunk larger.
    """
    if total <= chunk_bytes:
        return Dealer(np.zeros(0, np.int64), {})
    unit = max(1, chunk_bytes // 256)
    sizes = rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    large = sizes.groupBy("doc_id").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).filter(F.col("bytes") > chunk_bytes)
    found = large.collect()  # fewer than there are chunks
    parts = {r["doc_id"]: int(min(r["n"], -(-2 * r["bytes"] // chunk_bytes))) for r in found}
    own, rest = np.array(sorted(parts), np.int64), total - sum(r["bytes"] for r in found)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = int(np.random.default_rng(TaskContext.get().partitionId()).integers(unit))
        for batch in batches:
            ids = np.asarray(batch.column("doc_id"))
            sums = held + np.cumsum(np.where(np.isin(ids, own), 0, np.asarray(batch.column("bytes"))))
            times = np.diff(sums // unit, prepend=0)
            held = int(sums[-1] % unit) if len(sums) else held
            for at in range(0, len(ids), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[at : at + 1000], times[at : at + 1000]))], names=["doc_id"])

    count = max(2, -(-rest // chunk_bytes))
    # kept: the bounds take it through Python again, and a task that runs two Python steps holds two workers
    return Dealer(_bounds(checkpointed(sizes.mapInArrow(sampled, "doc_id long")), count), parts)


def remove_repeats(
    docs: DataFrame, width: int = 50, *, keep: list[str] | None = None, with_text: bool = False, chunk_bytes: int = CHUNK_BYTES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Remove every byte covered by a ``width``-byte string that also starts in a document of a smaller id.

    Returns per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 (of the remaining bytes), with ``with_text`` also kept_text (those
    bytes as text, without letters of which a byte was removed), and the ``keep``
    columns unchanged.

    Texts are judged as given, not after removals. Equal texts are found first
    by their SHA-256: all but the smallest id go whole if they have ``width``
    bytes. Names of suffixes are 63-bit hashes.

    Null and empty texts have 0 bytes and nothing removed. Rows with a null id
    are left as they are and remove nothing elsewhere. Rows of one id do not
    remove from each other; all of them count as sources. An empty table gives
    no rows. Columns not in ``keep`` are not read.
    """
    keep = keep or []
    if width < 2 * PERIOD:
        raise ValueError(f"width must be at least {2 * PERIOD}")
    with_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    )
    unknown, rows = rows.filter("doc_id is null"), rows.filter("doc_id is not null")
    total = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    deal = dealer(rows, total, chunk_bytes)
    names = total * len(COVER) // PERIOD
    bits = min(NAME_BITS, max(32, names.bit_length() + 10))
    buckets = max(1, -(-names // BUCKET_NAMES))
    inner = rows.schema

    def to_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rng = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            chunk = deal.chunk(np.asarray(batch.column("doc_id")), rng.integers(1 << 40, size=batch.num_rows))
            order = np.argsort(chunk, kind="stable")
            ordered, chunk = batch.take(pa.array(order)), chunk[order]
            first = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]) if len(chunk) else []
            for a, z in zip(first, [*first[1:], len(chunk)]):
                part = pa.concat_batches([ordered.slice(a, z - a)]).serialize()
                data = compressed(part, 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk[a]], pa.int32()), pa.array([len(part)], pa.int64()), pa.array([data], pa.binary())], names=["chunk", "raw", "data"]
                )

    def add_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, which = deal.chunks(np.asarray(batch.column("doc_id")))
            n = len(chunk)
            yield pa.RecordBatch.from_arrays([
                pa.array(chunk), pa.array([COPY] * n, pa.int32()), pa.array([0] * n, pa.int32()),
                batch.column("doc_id").take(pa.array(which)), pa.array([None] * n, pa.binary()),
            ], names=_REPLY.names)

    blob = StructType([StructField("chunk", IntegerType()), StructField("raw", LongType()), StructField("data", BinaryType())])
    # dealt out once; the checkpoint keeps its partitioning, so the joins below do not move it again
    chunk_count = len(deal.order)
    deals = min(chunk_count, max(parallelism(docs.sparkSession), -(-chunk_count // TASK_CHUNKS)))
    chunks = checkpointed(rows.mapInArrow(to_chunks, blob).repartition(deals, "chunk"), partitioned=True)
    arrow = _arrow_schema(inner)

    whole = rows.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha")).filter("sha is not null")
    least = whole.groupBy("sha").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").drop("most")
    copies = whole.join(checkpointed(least), "sha").filter("doc_id > least").select("doc_id").distinct()
    told = checkpointed(copies.mapInArrow(add_chunk, _REPLY))

    def opened(table: pa.Table, extra: pa.Table) -> Chunk:
        parts = [
            pa.ipc.read_record_batch(pa.py_buffer(decompressed(d, r)), arrow)
            for d, r in zip(table.column("data").to_pylist(), table.column("raw").to_pylist())
        ]
        return Chunk(pa.Table.from_batches(parts, arrow), extra, width, bits, buckets)

    def meet(work, schema: StructType, told: DataFrame) -> DataFrame:
        def run(table: pa.Table, extra: pa.Table) -> pa.Table:
            if not table.num_rows:
                return _arrow_schema(schema).empty_table()
            return work(table.column("chunk")[0].as_py(), opened(table, extra))

        return chunks.groupBy("chunk").cogroup(fresh(told).groupBy("chunk")).applyInArrow(run, schema)

    def answered(work, kind: int) -> DataFrame:
        """Requests of all chunks and the buckets' replies, kept; the requests' shuffle may then go."""
        replies = checkpointed(meet(work, _REQUEST, told).groupBy("bucket").applyInArrow(_bucket_reply(kind, deal.order), _REPLY))
        release(docs.sparkSession)
        return told.union(replies)

    release(docs.sparkSession)
    told = answered(lambda c, own: own.requests(c, own.cover_names()[0], own.step), SHARED)
    told = answered(lambda c, own: own.requests(c, own.suffix_names()[0], own.wide), EARLIER)

    result = StructType([
        StructField("doc_id", LongType()), StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
        StructField("n_spans", LongType()), StructField("kept_sha256", StringType()),
        *([StructField("kept_text", StringType())] if with_text else []), *inner.fields[2:],
    ])

    def finish(_: int, own: Chunk) -> pa.Table:
        removed, spans, kept = own.kept()
        return pa.table([
            own.docs.column("doc_id"), pa.array([len(t or b"") for t in own.texts], pa.int64()), pa.array(removed, pa.int64()),
            pa.array(spans, pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
            *([pa.array([t.decode("utf-8", "ignore") for t in kept], pa.string())] if with_text else []), *own.docs.columns[2:],
        ], names=result.names)

    out = meet(finish, result, told)
    text = F.coalesce("text", F.lit(""))
    alike = unknown.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"),
        *([text.alias("kept_text")] if with_text else []), *inner.names[2:],
    )
    out = out.union(alike)
    return out.select(*result.names[: len(result.names) - len(keep)], *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)])


def _arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
