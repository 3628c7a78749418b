"""Exact nearest neighbours by a block matrix join with int8 tiles.

Queries and candidates are cut into blocks; every pair of blocks is one tile.
A tile multiplies int8 codes, bounds what the codes may be off by, keeps the
pairs that can still be among the nearest, and scores those on the original
vectors in double precision.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from strata.llm.common import fresh, with_package
from strata.llm.vectors import matrix, shifted, unit, usable

_OUT = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])
#: Room for the rounding of double arithmetic in the bounds.
ROUNDING = 1e-12


def quantised(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and lengths of what the codes leave out, of unit rows."""
    scale = np.abs(rows).max(1) / 127
    code = np.rint(rows / scale[:, None])
    rest = rows - code * scale[:, None]
    return code.astype(np.int8), scale, np.sqrt(np.einsum("ij,ij->i", rest, rest))


def tile_nearest(query: np.ndarray, qid: np.ndarray, cand: np.ndarray, cid: np.ndarray, k: int, rows: int = 256):
    """Per query its k nearest of the tile: (query number, candidate number, cosine).

    |x.y - sx sy qx.qy| <= rx + (1 + rx) ry for unit x, y with codes q, scales s
    and left-out lengths r. A pair survives if its upper bound reaches the k-th
    largest lower bound of its query.
    """
    ux, uy = unit(query), unit(cand)
    query_rows, cand_rows = shifted(query), shifted(cand)
    (qx, sx, rx), (qy, sy, ry) = quantised(ux), quantised(uy)
    # sums of int8 products up to this dimension are whole numbers that float32 holds exactly
    kind = np.float32 if query.shape[1] * 127 * 127 < 1 << 24 else np.float64
    tile, codes = qy.astype(kind).T, qx.astype(kind)
    for a in range(0, len(query), rows):
        b = min(a + rows, len(query))
        near = (codes[a:b] @ tile).astype(np.float64) * sx[a:b, None] * sy[None, :]
        off = rx[a:b, None] + (1 + rx[a:b, None]) * ry[None, :] + ROUNDING
        low = near - off
        own = qid[a:b, None] == cid[None, :]
        low[own] = -np.inf
        bar = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(b - a, -np.inf)
        alive = (near + off >= bar[:, None]) & ~own
        i, j = np.nonzero(alive)
        x, y = query_rows[a + i], cand_rows[j]
        dot = np.einsum("ij,ij->i", x, y)
        score = dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))
        cut = np.searchsorted(i, np.arange(b - a + 1))
        for q in range(b - a):
            span = range(cut[q], cut[q + 1])
            for p in heapq.nsmallest(k, span, key=lambda p: (-score[p], cid[j[p]])):
                yield a + q, int(j[p]), float(score[p])


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, *, query_block: int = 4096, candidate_block: int = 4096,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest rows of every query row by cosine: query_id, rank (from 1), vec_id, score.

    All rows but the query's own id are candidates. Ties go to the smaller id;
    with fewer than k candidates all are returned. Exact: the codes only rule
    out pairs that cannot be among the k nearest. Vectors that are null, zero or
    hold a null or non-finite component take no part, and vectors are compared
    with vectors of the same length only. Rows with a null id take no part.
    Vectors of very large or very small components are scored like any others: a
    vector's scale does not change its cosines.
    Repeated rows of one id are further candidates with that id. Empty tables
    give no rows; other columns are not read.

    Block sizes bound a tile's memory; a block's rows are dealt by a hash of the
    id, so a very common vector makes no large block.
    """
    with_package(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("q")
    ).filter(usable(F.col("v")) & F.col("vec_id").isNotNull()).withColumn("dim", F.size("v"))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("q"), 1)).alias("q")).first()
    many_q, many_c = max(1, -(-n["q"] // query_block)), max(1, -(-n["n"] // candidate_block))
    part = lambda by: F.pmod(F.xxhash64("vec_id"), F.lit(by)).cast("int")
    every = lambda by: F.explode(F.sequence(F.lit(0), F.lit(by - 1)))
    queries = rows.filter("q").select("dim", part(many_q).alias("qb"), every(many_c).alias("cb"), "vec_id", "v")
    candidates = rows.select("dim", every(many_q).alias("qb"), part(many_c).alias("cb"), "vec_id", "v")

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            qid, cid = np.asarray(left.column("vec_id")), np.asarray(right.column("vec_id"))
            for q, c, score in tile_nearest(matrix(left.column("v")), qid, matrix(right.column("v")), cid, k):
                found.append((int(qid[q]), int(cid[c]), score))
        columns = list(zip(*found)) if found else [(), (), ()]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=_OUT.names)

    keys = ["dim", "qb", "cb"]
    tops = queries.groupBy(*keys).cogroup(fresh(candidates).groupBy(*keys)).applyInArrow(tile, _OUT)
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = tops.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
