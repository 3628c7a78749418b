"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for each half of a vector, span a grid of cells. A vector
lies in the cell of its two nearest codewords and visits the cells whose
codewords are nearest in sum (the multi-sequence order), as many as the links
of sampled rows to all rows need to reach the target recall; vectors that meet
are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from strata.llm.common import checkpointed, components, fresh, parallelism, with_package
from strata.llm.vectors import matrix, unit, usable

#: Rows of one side that meet in one task.
BLOCK = 2000
#: Rows that are compared with all others to fit the number of visits, and how many of them must have links.
QUERIES, LINKED_QUERIES = 2000, 200
#: Vector lengths whose cells are kept together before the next ones are fitted.
KEPT_DIMS = 32


def codebook(rows: np.ndarray, words: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's k-means on a bounded sample."""
    rng = np.random.default_rng(seed)
    words = min(words, len(rows))
    centers = rows[rng.choice(len(rows), words, replace=False)].copy()
    for _ in range(rounds):
        near = distances(rows, centers).argmin(1)
        for c in range(words):
            own = rows[near == c]
            centers[c] = own.mean(0) if len(own) else rows[rng.integers(len(rows))]
    return centers


def distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, without the part that is the same for all centers of a row."""
    return (centers**2).sum(1)[None, :] - 2 * rows @ centers.T


class Grid:
    """Product of two codebooks, with the order in which a vector visits its cells."""

    def __init__(self, sample: np.ndarray, words: int = 32, rounds: int = 12, seed: int = 3):
        self.half = sample.shape[1] // 2
        self.books = [codebook(sample[:, : self.half], words, rounds, seed), codebook(sample[:, self.half :], words, rounds, seed + 1)]
        self.cells = len(self.books[0]) * len(self.books[1])

    def visits(self, rows: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` nearest cells of each row, nearest first.

        The t-th cell of the multi-sequence order pairs the a-th word of one
        book with the b-th of the other with (a + 1)(b + 1) <= t, so only such
        pairs are looked at.
        """
        d1, d2 = distances(rows[:, : self.half], self.books[0]), distances(rows[:, self.half :], self.books[1])
        o1, o2 = d1.argsort(1, kind="stable"), d2.argsort(1, kind="stable")
        s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
        pairs = [(a, b) for a in range(d1.shape[1]) for b in range(d2.shape[1]) if (a + 1) * (b + 1) <= count]
        a, b = np.array(pairs).T
        best = (s1[:, a] + s2[:, b]).argsort(1, kind="stable")[:, :count]
        return (o1[np.arange(len(rows))[:, None], a[best]] * d2.shape[1] + o2[np.arange(len(rows))[:, None], b[best]]).astype(np.int32)

    def places(self, rows: np.ndarray) -> np.ndarray:
        """The turn (from 0) at which each row visits each cell, all cells counted."""
        order = self.visits(rows, self.cells)
        out = np.empty(order.shape, np.int32)
        np.put_along_axis(out, order, np.arange(self.cells, dtype=np.int32)[None, :], 1)
        return out

    def threshold_turns(self, query: np.ndarray, cosine: float, seed: int = 5) -> np.ndarray:
        """Turns at which either end finds the other for partners made at just the threshold, in random directions."""
        side = np.random.default_rng(seed).normal(size=query.shape)
        side = unit(side - (side * query).sum(1, keepdims=True) * query)
        other = cosine * query + (1 - cosine**2) ** 0.5 * side
        at = np.arange(len(query))
        return np.minimum(self.places(query)[at, self.visits(other, 1)[:, 0]], self.places(other)[at, self.visits(query, 1)[:, 0]])


def enough(turns: np.ndarray, counts: np.ndarray, recall: float) -> int:
    """Visits that find ``recall`` of links of which ``counts`` are found at each of ``turns`` (from 0)."""
    order = np.argsort(turns)
    found = np.cumsum(counts[order])
    return int(turns[order][np.searchsorted(found, int(np.ceil(recall * found[-1])))]) + 1 if len(turns) else 0


_TURNS = StructType([StructField("query", IntegerType()), StructField("turn", IntegerType()), StructField("links", LongType())])


def _links_by_turn(own: DataFrame, grid: Grid, query: np.ndarray, ids: np.ndarray, cosine: float) -> list:
    """Links of the queries to all rows of ``own``, counted by query and by the turn at which either end finds the other."""
    spark = own.sparkSession
    shared = spark.sparkContext.broadcast((grid, query, ids, grid.places(query), grid.visits(query, 1)[:, 0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, query, ids, place, home = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = unit(matrix(part.column("v")))
                r, q = np.nonzero((rows @ query.T >= cosine) & (np.asarray(part.column("rep"))[:, None] != ids[None, :]))
                if not len(r):
                    continue
                hit, r = np.unique(r, return_inverse=True)
                turn = np.minimum(place[q, grid.visits(rows[hit], 1)[r, 0]], grid.places(rows[hit])[r, home[q]])
                key, n = np.unique(q * np.int64(grid.cells) + turn, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key // grid.cells, pa.int32()), pa.array(key % grid.cells, pa.int32()), pa.array(n, pa.int64())], names=_TURNS.names
                )

    return own.select("rep", "v").mapInArrow(run, _TURNS).groupBy("query", "turn").agg(F.sum("links").alias("links")).collect()


def fitted_visits(own: DataFrame, rows: int, grid: Grid, query: np.ndarray, ids: np.ndarray, cosine: float, recall: float, least: int) -> int:
    """Visits at which ``recall`` of the queries' links to all rows of ``own`` are found, either end counted.

    The queries are compared with every row. Where they are not all of the rows
    and have too few links to tell (fewer than ten that may be missed, or from
    fewer than ``LINKED_QUERIES`` queries), as many visits are made as find
    ``recall`` of partners at just the threshold in random directions, too.
    """
    seen = _links_by_turn(own, grid, query, ids, cosine)
    turns, links = (np.array([r[c] for r in seen], np.int64) for c in ("turn", "links"))
    count = max(least, enough(turns, links, recall))
    few = links.sum() < 10 / (1 - min(recall, 0.9999)) or len({r["query"] for r in seen}) < LINKED_QUERIES
    if few and len(query) < rows:
        made = grid.threshold_turns(query, cosine)
        count = max(count, enough(made, np.ones(len(made), np.int64), recall))
    return min(count, grid.cells)


_ASSIGNED = StructType([StructField("rep", LongType()), StructField("home", IntegerType()), StructField("visits", ArrayType(IntegerType()))])
_FOUND = StructType([
    StructField("kind", IntegerType()), StructField("a", LongType()), StructField("b", LongType()),
])


def _tile(cosine: float):
    """One block pair of a cell: link counts (kind 0: id, weight) and a spanning forest (kind 1: edge)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.int64())], names=_FOUND.names)
        if not left.num_rows or not right.num_rows:
            return empty
        member, guest = np.asarray(left.column("rep")), np.asarray(right.column("rep"))
        member_n, guest_n = np.asarray(left.column("m")), np.asarray(right.column("m"))
        x, y = unit(matrix(left.column("v"))), unit(matrix(right.column("v")))
        home = np.asarray(right.column("home"))
        order = left.column("visits").combine_chunks()
        visited = np.asarray(order.flatten()).reshape(len(member), -1)
        for_member, for_guest = np.zeros(len(member), np.int64), np.zeros(len(guest), np.int64)
        pairs = []
        for at in range(0, len(guest), 256):
            part = slice(at, at + 256)
            near = (y[part] @ x.T >= cosine) & (guest[part, None] != member[None, :])
            # a member that visits the guest's own cell finds the guest itself, over there
            also = np.isin(home[part], visited)
            one_way = near.copy()
            for g in np.flatnonzero(also & near.any(1)):
                one_way[g] &= ~(visited == home[at + g]).any(1)
            for_guest[part] += near @ member_n
            for_member += guest_n[part] @ one_way
            g, m = np.nonzero(near)
            pairs.append(np.stack([g + at, m]))
        g, m = np.concatenate(pairs, 1)
        edges = _forest(guest, member, g, m)
        counted = np.r_[for_guest, for_member]
        ids = np.r_[guest, member]
        at = counted > 0
        return pa.table([
            pa.array(np.r_[np.zeros(at.sum(), np.int32), np.ones(len(edges[0]), np.int32)]),
            pa.array(np.r_[ids[at], edges[0]]), pa.array(np.r_[counted[at], edges[1]]),
        ], names=_FOUND.names)

    return run


def _forest(guest: np.ndarray, member: np.ndarray, g: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, smallest id of its component) of the links guest[g] - member[m]."""
    if not len(g):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids = np.r_[guest[g], member[m]]
    nodes, at = np.unique(ids, return_inverse=True)
    a, b = at[: len(g)], at[len(g) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def near_vectors(
    vectors: DataFrame, cosine: float = 0.9, recall: float = 0.999, *, words: int = 32, fit_rows: int = 20_000, least_visits: int = 8,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Links between vectors of cosine at least ``cosine``: one row per vector.

    Returns vec_id, n_links (other rows linked directly), component_id (smallest
    id reachable), kept (vec_id = component_id).

    Equal vectors are one class with a count. Codebooks are fitted on the
    ``fit_rows`` representatives of smallest id hash; the number of cells to
    visit on the first ``QUERIES`` of them, compared with all representatives
    (see ``fitted_visits``); all rows are indexed. Members and visitors of a cell
    meet in pairs of blocks of bounded size, which return counts and spanning
    forests, not pairs. Every pair that meets is compared in double precision,
    so no link is false; the share of links that meet is the recall, at least
    ``recall`` over the links of the queries. A vector length of at most
    ``BLOCK`` representatives is one cell, which finds all of its links.

    Vectors that are null, zero or hold a null or non-finite component have no
    links and are their own component. Vectors are compared with vectors of the
    same length only; any number of lengths is indexed, with a codebook for each
    of more than ``BLOCK`` representatives. Rows with a null id are linked with nothing (component
    null, not kept). Rows of one id count as one vector each but share links'
    component. Empty tables give no rows; other columns are not read.
    """
    with_package(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = usable(F.col("v")) & F.col("vec_id").isNotNull()
    classes = checkpointed(rows.filter(good).groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m")).withColumn("dim", F.size("v")))
    spark, parts = rows.sparkSession, []
    # vectors of a length with few rows are one cell, where all of them meet
    sizes = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    small = [d for d, n in sizes.items() if n <= BLOCK]
    if small:
        one = F.lit(0).alias("home")
        parts.append(classes.filter(F.col("dim").isin(small) if len(small) < len(sizes) else F.lit(True)).select("rep", one, F.array(F.lit(0)).alias("visits"), "dim"))
    for dim in sorted(sizes.keys() - set(small)):
        own = classes.filter(F.col("dim") == dim)
        sample = own.orderBy(F.xxhash64("rep"), "rep").limit(fit_rows).select("rep", "v").toArrow()
        base, ids = unit(matrix(sample.column("v"))), np.asarray(sample.column("rep"))
        grid = Grid(base, words)
        count = fitted_visits(own, sizes[dim], grid, base[:QUERIES], ids[:QUERIES], cosine, recall, least_visits)
        parts.append(_assign(spark, own, grid, count, dim))
        if len(parts) > KEPT_DIMS:
            parts = [checkpointed(reduce(DataFrame.union, parts))]
    found = checkpointed(_meet(classes, parts, cosine)) if parts else None
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    links = found.filter("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("links"))
    comp = components(found.filter("kind = 1").select("a", "b")).select(F.col("node").alias("rep"), "component")
    label = classes.join(links, "rep", "left").join(comp, "rep", "left").select(
        F.col("v").alias("__v"), (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("component")
    )
    keyed = rows.withColumn("__key", F.when(good, F.col("v")))
    out = keyed.join(label, F.col("__key") == F.col("__v"), "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _assign(spark, own: DataFrame, grid: Grid, count: int, dim: int) -> DataFrame:
    """rep, dim, home cell and visited cells of every representative."""
    shared = spark.sparkContext.broadcast(grid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                order = shared.value.visits(unit(matrix(part.column("v"))), count)
                yield pa.RecordBatch.from_arrays([
                    part.column("rep"), pa.array(order[:, 0]),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, order.size + 1, order.shape[1]), pa.int32()), pa.array(order.ravel())),
                ], names=_ASSIGNED.names)

    return own.select("rep", "v").mapInArrow(run, _ASSIGNED).withColumn("dim", F.lit(dim))


def _meet(classes: DataFrame, parts: list[DataFrame], cosine: float) -> DataFrame:
    assigned = reduce(DataFrame.union, parts)
    full = checkpointed(assigned.join(classes.drop("dim"), "rep"))
    members = full.select("dim", F.col("home").alias("cell"), "rep", "m", "v", "visits")
    guests = full.select("dim", F.explode("visits").alias("cell"), "rep", "m", "v", "home")
    blocks = lambda df, name: df.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias(name))
    sizes = checkpointed(blocks(members, "mk").join(blocks(guests.select("dim", "cell"), "gk"), ["dim", "cell"]))
    own = lambda k: F.pmod(F.xxhash64("rep", F.lit(5)), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    left = members.join(sizes, ["dim", "cell"]).withColumns({"mb": own("mk")}).withColumn("gb", every("gk"))
    right = guests.join(sizes, ["dim", "cell"]).withColumns({"gb": own("gk")}).withColumn("mb", every("mk"))
    keys = ["dim", "cell", "mb", "gb"]
    # by all keys: dealt by the cell alone, a full cell's blocks would stay in one task
    n = parallelism(classes.sparkSession)
    left = left.select(*keys, "rep", "m", "v", "visits").repartition(n, *keys)
    right = right.select(*keys, "rep", "m", "v", "home").repartition(n, *keys)
    return left.groupBy(*keys).cogroup(fresh(right).groupBy(*keys)).applyInArrow(_tile(cosine), _FOUND)
