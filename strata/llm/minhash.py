"""Near-duplicate documents by HyperMinHash.

A sketch has ``REGISTERS`` registers; each holds the smallest hash of the
document's word shingles under its own hash function, compressed to its
leading-zero count (6 bits) and the mantissa bits that follow (10 bits). Bands
of registers propose pairs, the collision-corrected Jaccard estimate of the
registers drops the hopeless ones, and full shingle sets decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from strata.llm.common import checkpointed, components, release, with_package
from strata.llm.kernels import shingle_sets, slices, texts_of

BAND_ROWS, BANDS = 3, 24
REGISTERS = BAND_ROWS * BANDS
MANTISSA = 10
#: Text that is shingled at once; its arrays take about 65 times that.
SLICE_BYTES = 256 << 10
#: Members of a bucket that meet in one task; larger buckets are cut into blocks.
BLOCK = 400
_SEED = np.random.default_rng(41).integers(1, 2**63, (2, REGISTERS), dtype=np.uint64) | np.uint64(1)


def registers(values: np.ndarray) -> np.ndarray:
    """The compressed registers of one set of 64-bit shingle hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max)
    for at in range(0, len(values), 2048):
        h = (values[at : at + 2048, None] ^ _SEED[0]) * _SEED[1]
        np.minimum(least, (h ^ (h >> np.uint64(31))).min(0) if len(h) else least, out=least)
    # 53 leading bits are exact in a double: exponent = leading zeros, fraction = mantissa
    fraction, exponent = np.frexp((least >> np.uint64(11)).astype(np.float64))
    zeros = np.minimum(53 - exponent, 63).astype(np.uint16)
    bits = ((fraction - 0.5) * (1 << (MANTISSA + 1))).clip(0).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA)) | bits


def estimate(equal: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Jaccard estimate from the number of equal registers.

    Two unrelated minima fall into one cell of relative width 2**-MANTISSA with
    chance 0.72 * 2**-MANTISSA * n1 n2 / (n1 + n2)**2, which is taken out.
    """
    chance = 0.72 * 2.0**-MANTISSA * n1 * n2 / (n1 + n2) ** 2
    return np.clip((equal / REGISTERS - chance) / (1 - chance), 0, 1)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest (of the shingle set), sketch. Row by row; null text: 0 shingles."""
    with_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([
        StructField("doc_id", LongType()), StructField("n_shingles", LongType()), StructField("digest", BinaryType()), StructField("sketch", BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(texts_of(part, "text"))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([registers(s).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                ], names=schema.names)

    return rows.mapInArrow(run, schema)


def full_sets(docs: DataFrame) -> DataFrame:
    """doc_id, shingles (sorted distinct hashes) of documents doc_id, text."""
    schema = StructType([StructField("doc_id", LongType()), StructField("shingles", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = [s.view(np.int64) for s in shingle_sets(texts_of(part, "text"))]
                flat = np.concatenate([np.zeros(0, np.int64), *sets])
                at = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))], names=schema.names
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def confirmed(pairs: DataFrame, sets: DataFrame, share: int = 75) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= share * union."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("__a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("__b"))
    both = F.size(F.array_intersect("__a", "__b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.filter(100 * both >= share * (F.size("__a") + F.size("__b") - both)).select("a", "b")


def _promising(share: float):
    """Drop pairs whose estimate is five standard errors below the threshold."""
    least = share - 5 * (share * (1 - share) / REGISTERS) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sa, sb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            na, nb = (np.asarray(batch.column(c), np.float64) for c in ("na", "nb"))
            good = (estimate((sa == sb).sum(1), na, nb) >= least) & (np.minimum(na, nb) >= share * np.maximum(na, nb))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good))

    return run


def promising(pairs: DataFrame, reps: DataFrame, share: int) -> DataFrame:
    pair = StructType([StructField("a", LongType()), StructField("b", LongType())])
    side = lambda c: reps.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInArrow(_promising(share / 100), pair)


def stray_blocks(members: DataFrame, block: int, payload: DataFrame) -> DataFrame:
    """Deal the members (band, rep, component) of open bands to tasks (band, x, y) of strays and members.

    The members of a band outside its largest component are its strays. Only
    pairs of a stray and a member can join components, so strays are cut into
    blocks x, all members into blocks y of about ``block`` rows, and every two of
    them meet. A band of n members with few strays makes about 2 n rows.

    Members and sizes are kept before they are joined: adaptive execution splits
    a hot band only where neither side is still being aggregated. The ``payload``
    (one row per ``rep``) comes last, when all bands are cut.
    """
    members = checkpointed(members.select("band", "rep", "component"))
    parts = members.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    bands = parts.groupBy("band").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("main"))
    blocks = lambda n: F.ceil(n / F.lit(block)).cast("int")
    size = checkpointed(bands.select(
        "band", F.col("main.component").alias("main"), blocks(F.col("n") - F.col("main.n")).alias("xs"), blocks(F.col("n")).alias("ys")
    ).filter("xs > 0"))
    sized = checkpointed(members.join(size, "band"))
    part = lambda by, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(by)).cast("int")
    every = lambda by: F.explode(F.sequence(F.lit(0), F.col(by) - 1))
    strays = sized.filter("component <> main").select("band", part("xs", 7).alias("x"), every("ys").alias("y"), "rep", "component", F.lit(True).alias("stray"))
    others = sized.select("band", every("xs").alias("x"), part("ys", 5).alias("y"), "rep", "component", F.lit(False).alias("stray"))
    # by all keys: dealt by the band alone, a large band's blocks would stay in one task
    return strays.union(others).join(payload, "rep").repartition("band", "x", "y")


_MEMBER = StructType([StructField("band", LongType()), StructField("rep", LongType()), StructField("component", LongType())])
_EDGE = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _cross_candidates(share: float):
    """Of the strays and members of one task, those with a promising partner in another component."""
    least = share - 5 * (share * (1 - share) / REGISTERS) ** 0.5

    def run(table: pa.Table) -> pa.Table:
        rep, comp = np.asarray(table.column("rep")), np.asarray(table.column("component"))
        n = np.asarray(table.column("n"), np.float64)
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(len(rep), -1)
        stray = np.asarray(table.column("stray"))
        found = np.zeros(len(rep), bool)
        strays, others = np.flatnonzero(stray), np.flatnonzero(~stray)
        for at in range(0, len(strays), 64):
            part = strays[at : at + 64]
            equal = np.zeros((len(part), len(others)), np.int16)
            for r in range(REGISTERS):
                equal += sketch[part, r, None] == sketch[None, others, r]
            good = comp[part, None] != comp[None, others]
            good &= np.minimum(n[part, None], n[None, others]) >= share * np.maximum(n[part, None], n[None, others])
            good &= estimate(equal, n[part, None], n[None, others]) >= least
            found[part] |= good.any(1)
            found[others] |= good.any(0)
        at = np.flatnonzero(found)
        return pa.table([table.column("band").take(pa.array(at)), pa.array(rep[at]), pa.array(comp[at])], names=["band", "rep", "component"])

    return run


def intersections(flat: np.ndarray, owner: np.ndarray, members: int, columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of sets given as (value, owner) lists, by products of 0/1 tiles."""
    out = np.zeros((members, members), np.float32)
    order = np.argsort(flat, kind="stable")
    value, owner = flat[order], owner[order]
    fresh = np.r_[True, value[1:] != value[:-1]] if len(value) else np.zeros(0, bool)
    which = np.cumsum(fresh) - 1
    count = np.bincount(which) if len(which) else np.zeros(0, int)
    shared = count[which] > 1 if len(which) else np.zeros(0, bool)  # a value of one set adds to no pair
    which = np.unique(which[shared], return_inverse=True)[1] if shared.any() else np.zeros(0, int)
    owner = owner[shared]
    for at in range(0, int(which[-1]) + 1 if len(which) else 0, columns):
        a, b = np.searchsorted(which, [at, at + columns])
        tile = np.zeros((members, columns), np.float32)
        tile[owner[a:b], which[a:b] - at] = 1
        out += tile @ tile.T
    return out


def forest(link: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, smallest id of its component) of a symmetric link matrix."""
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(link, label[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
        if (new == label).all():
            break
        label = new
    at = label != ids
    return ids[at], label[at]


def _exact_links(share: int):
    """Of the strays and members of one task, a spanning forest of the links between full sets."""

    def run(table: pa.Table) -> pa.Table:
        rep, once = np.unique(np.asarray(table.column("rep")), return_index=True)  # a stray may be there as a member too
        table = table.take(pa.array(once))
        column = table.column("shingles").combine_chunks()
        size = np.asarray(pc.list_value_length(column), np.int64)
        both = intersections(np.asarray(column.flatten()), np.repeat(np.arange(len(rep)), size), len(rep))
        link = 100 * both >= share * (size[:, None] + size[None, :] - both)
        np.fill_diagonal(link, False)
        a, b = forest(link, rep)
        return pa.table([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, share: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Connected components of documents with Jaccard similarity of at least ``share`` percent.

    Returns one row per input row: doc_id, n_shingles, component_id (smallest id
    reachable), kept (doc_id = component_id).

    1. Equal shingle sets are one class, represented by their smallest id.
    2. Every band of the representatives' registers is a bucket. Each member is
       compared with its bucket's smallest id: linear in the bucket, and enough
       for most copies of one text.
    3. In buckets that still hold several components, the members outside the
       largest one are compared with all members, in blocks of bounded size:
       registers first, then full sets for all that stay promising. Tasks return
       spanning forests, never all pairs.

    Frames that are read again are kept, and the shuffles they came from are
    dropped at once, so that disk holds one step's shuffles besides them.

    No bucket is capped. A pair at the threshold shares no band with chance
    (1 - 0.75**3)**24 < 3e-6, and less above it; links are confirmed on full sets.

    Texts of any length are shingled whole.
    Null, empty and blank texts have no shingles and no links; their component
    is their own id. Rows with a null id are linked with nothing (component
    null, not kept). Rows of one id count as one document with several texts.
    An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sk = checkpointed(sketches(texts))
    classes = sk.filter("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = checkpointed(classes)
    reps = classes.drop("digest")
    key = F.xxhash64("i", F.substring(F.col("sketch"), 2 * BAND_ROWS * F.col("i") + 1, F.lit(2 * BAND_ROWS)))
    bands = reps.select("rep", "sketch", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("i")).select(key.alias("band"), "rep")
    centers = bands.groupBy("band").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
    # kept before the join, so that a hot bucket can be split there
    bucketed = checkpointed(bands.join(checkpointed(centers), "band"))
    release(spark)

    # full sets of every document that shares a bucket: the text is dealt out once
    sharing = bucketed.select(F.col("rep").alias("doc_id")).distinct()
    sets = checkpointed(full_sets(texts.join(sharing, "doc_id", "left_semi")))
    release(spark)

    star = bucketed.filter("rep <> center").select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    links = checkpointed(confirmed(promising(star, reps, share), sets, share).distinct())
    release(spark)

    first = components(links).select(F.col("node").alias("rep"), "component")
    placed = bucketed.drop("center").join(first, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    placed = checkpointed(placed)
    release(spark)
    open_bands = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("band")
    members = placed.join(checkpointed(open_bands), "band")
    keys = ["band", "x", "y"]
    crossing = checkpointed(stray_blocks(members, BLOCK, reps).groupBy(*keys).applyInArrow(_cross_candidates(share / 100), _MEMBER).distinct())
    release(spark)
    full = sets.withColumnRenamed("doc_id", "rep")
    more = checkpointed(stray_blocks(crossing, BLOCK, full).groupBy(*keys).applyInArrow(_exact_links(share), _EDGE).distinct())
    release(spark)
    comp = components(links.union(more)).select(F.col("node").alias("rep"), "component")

    labelled = classes.select("digest", "rep").join(comp, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    rows = sk.select("doc_id", "n_shingles", "digest", (F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).alias("real"))
    joined = rows.join(labelled, "digest", "left")
    component = F.when(F.col("real"), F.col("component")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
