"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

A node holds split points; a row belongs to the subtree of its nearest one. For
every split point and every sibling subtree the node stores the least and the
greatest distance from the point to the subtree's rows. An anchor whose
allowed scores make an annulus of distances around it passes a subtree by when
the triangle inequality over any of these ranges leaves no distance in the
annulus. What remains is scored exactly in the leaves.

The tree is fitted to a bounded sample; every row is in a leaf, and the ranges
are taken over all rows, so nothing is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import checkpointed, fresh, with_package

#: Distances are compared with this share of the lengths involved as room for rounding.
ROUNDING = 1e-6
#: Up to this many (vector length, leaf) pairs their counts are broadcast; beyond, joined by shuffle.
BROADCAST_LEAVES = 100_000


def split_points(rows: np.ndarray, many: int) -> np.ndarray:
    """Places of at most ``many`` distinct rows, each the farthest from those before it."""
    chosen, far = [0], ((rows - rows[0]) ** 2).sum(1)
    while len(chosen) < many and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(1))
    return np.array(chosen)


def distances(rows: np.ndarray, points: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """From each row to each point; the shorter kind is taken as filled up with zeros."""
    shared = min(rows.shape[1], points.shape[1])
    squared = np.einsum("ij,ij->i", rows, rows)[:, None] + squares[None, :] - 2 * rows[:, :shared] @ points[:, :shared].T
    return np.sqrt(np.maximum(squared, 0))


@dataclass
class Tree:
    """Nodes in the order of their making: split points, and for each a child node (>= 0) or a leaf (-1 - number)."""

    points: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    squares: list[np.ndarray] = field(default_factory=list)
    path: list[list[tuple[int, int]]] = field(default_factory=list)
    low: list[np.ndarray] = field(default_factory=list)  # per node: distances from point i to subtree j
    high: list[np.ndarray] = field(default_factory=list)
    least: list[np.ndarray] = field(default_factory=list)  # per node: squared lengths in subtree j
    most: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def fit(cls, sample: np.ndarray, fanout: int, leaf_rows: int) -> Tree:
        tree = cls()
        waiting: list[tuple[np.ndarray, list[tuple[int, int]]]] = [(np.arange(len(sample)), [])]
        while waiting:
            mine, path = waiting.pop()
            chosen = split_points(sample[mine], fanout) if len(mine) > leaf_rows else np.zeros(1, int)
            if len(chosen) < 2:  # few rows, or equal ones only
                child = -1 - len(tree.path)
                tree.path.append(path)
            else:
                child, points = len(tree.points), sample[mine][chosen]
                tree.points.append(points)
                tree.squares.append(np.einsum("ij,ij->i", points, points))
                tree.children.append([0] * len(points))
                near = distances(sample[mine], points, tree.squares[child]).argmin(1)
                for j in range(len(points)):
                    waiting.append((mine[near == j], [*path, (child, j)]))
            if path:
                tree.children[path[-1][0]][path[-1][1]] = child
        return tree

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(rows), np.int64)
        waiting = [(0, np.arange(len(rows)))] if self.points else []
        while waiting:
            node, mine = waiting.pop()
            if not len(mine):
                continue
            near = distances(rows[mine], self.points[node], self.squares[node]).argmin(1)
            for j, child in enumerate(self.children[node]):
                if child < 0:
                    out[mine[near == j]] = -1 - child
                else:
                    waiting.append((child, mine[near == j]))
        return out

    def ranges(self, rows: np.ndarray, leaf: np.ndarray, into: dict[tuple[int, int, int], tuple[float, float]]) -> None:
        """Widen (node, point, subtree) ranges by rows of known leaves; point -1 stands for the squared length."""
        length = np.einsum("ij,ij->i", rows, rows)
        for number in np.unique(leaf):
            mine = leaf == number
            for node, j in self.path[number]:
                seen = distances(rows[mine], self.points[node], self.squares[node])
                spans = [(-1, length[mine].min(), length[mine].max()), *zip(range(seen.shape[1]), seen.min(0), seen.max(0))]
                for i, a, b in spans:
                    lo, hi = into.get((node, i, j), (np.inf, -np.inf))
                    into[node, i, j] = min(lo, float(a)), max(hi, float(b))

    def measured(self, ranges: list[tuple[int, int, int, float, float]]) -> Tree:
        """The tree with its ranges; a subtree without rows keeps an empty range, which nothing meets."""
        shape = [(len(p), len(p)) for p in self.points]
        self.low, self.high = [np.full(s, np.inf) for s in shape], [np.full(s, -np.inf) for s in shape]
        self.least, self.most = [np.full(s[0], np.inf) for s in shape], [np.full(s[0], -np.inf) for s in shape]
        for node, i, j, lo, hi in ranges:
            if i < 0:
                self.least[node][j], self.most[node][j] = lo, hi
            else:
                self.low[node][i, j], self.high[node][i, j] = lo, hi
        return self

    def visits(self, anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, anchors) that may hold a row whose inner product with the anchor is in one of its windows.

        ``lo`` and ``hi`` have a row per anchor and a column per window; a window
        with lo > hi is empty.
        """
        alive = lo <= hi
        if not self.points:
            mine = np.flatnonzero(alive.any(1))
            if len(mine):
                yield 0, mine
            return
        length = np.einsum("ij,ij->i", anchors, anchors)
        waiting = [(0, np.flatnonzero(alive.any(1)), alive[alive.any(1)])]
        while waiting:
            node, mine, open_ = waiting.pop()
            if not len(mine):
                continue
            away = distances(anchors[mine], self.points[node], self.squares[node])
            for j, child in enumerate(self.children[node]):
                if not np.isfinite(self.most[node][j]):
                    continue
                room = ROUNDING * (np.sqrt(length[mine]) + np.sqrt(self.most[node][j]) + np.sqrt(self.squares[node].max())) + ROUNDING
                near = np.maximum(self.low[node][:, j] - away, away - self.high[node][:, j]).max(1) - room
                far = (away + self.high[node][:, j]).min(1) + room
                # |a - x|^2 = |a|^2 + |x|^2 - 2 a.x: the windows as annuli around the anchor
                inner = length[mine, None] + self.least[node][j] - 2 * hi[mine]
                outer = length[mine, None] + self.most[node][j] - 2 * lo[mine]
                meets = (outer >= 0) & (near[:, None] <= np.sqrt(np.maximum(outer, 0))) & (far[:, None] >= np.sqrt(np.maximum(inner, 0)))
                still = open_ & meets
                some = still.any(1)
                if not some.any():
                    continue
                if child < 0:
                    yield -1 - child, mine[some]
                else:
                    waiting.append((child, mine[some], still[some]))


def whole(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long whole-number vectors as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.int64)
    return flat.reshape(len(column), -1) if len(column) and len(flat) else np.zeros((len(column), 0), np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows: by doubles where these hold every partial sum, else by longs."""
    bound = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * positive <= 100 s <= high * positive (empty if the first exceeds the second)."""
    return -((-low * positive) // 100), (high * positive) // 100


def best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest allowed scores, ties to smaller ids."""
    places = np.flatnonzero(allowed)
    if len(places) > k:
        bar = np.partition(scores[places], len(places) - k)[len(places) - k]
        places = places[scores[places] >= bar]
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _by_length(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """Parts of a batch whose vectors are equally long, with their places."""
    table = pa.table(batch) if isinstance(batch, pa.Table) else pa.Table.from_batches([batch])
    size = np.asarray(table.column("dim"))
    for n in np.unique(size):
        mine = np.flatnonzero(size == n)
        yield mine, table.take(mine)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, *, label: Column | None = None, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, scale: int = 256, fit_rows: int = 4096, fanout: int = 16, leaf_rows: int = 32,
    block: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Per anchor and positive the hardest negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(``scale`` * x); a score is the exact inner product
    with the anchor. The positives of an anchor are its ``positives`` best other
    rows of the same label; the negatives of a positive are the ``negatives`` best
    rows of another label whose score is between ``low`` and ``high`` percent of
    the positive's (``rank`` from 1). Ties go to the smaller id; fewer are
    returned where there are fewer. A positive score below 0 allows no negative,
    0 allows scores of 0. ``is_anchor`` and ``label`` may use the table's columns.

    Rows with a null id, label or vector or a null or non-finite component take
    no part, nor do vectors with a component so large that scores may exceed a
    long. Vectors are compared with vectors of the same length. Rows equal in id,
    label and vector count once; rows that only share an id are rows of their
    own, but none is a positive or negative of an anchor of that id. Empty tables
    give no rows; other columns are not read.

    ``fit_rows`` bounds the sample that gives the split points and first bounds
    of the scores to be found; it is collected and sent to every task, like the
    ranges (at most ``fanout`` a split point). All rows are indexed. Leaves and
    their anchors meet in tiles of about ``block`` by ``block`` rows, dealt by a
    hash of the whole row, so a vector that holds a third of all rows is many
    tiles and not one.
    """
    spark = vectors.sparkSession
    with_package(spark)
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(x * scale))
    limit = F.floor(F.sqrt(F.lit(float(2**63 - 2**11)) / F.greatest(F.size(vector_col), F.lit(1))))
    fits = F.forall(F.col(vector_col).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < limit))
    plain = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), (F.col(label_col) if label is None else label).cast("long").alias("label"),
        F.when(fits, scaled).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("q"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = plain.dropDuplicates(["vec_id", "label", "v"]).withColumn("dim", F.size("v")).withColumn("row", F.xxhash64("label", "v"))
    rows = checkpointed(rows)
    picked = rows.orderBy(F.xxhash64("vec_id", "row"), "vec_id", "row").limit(fit_rows).select("vec_id", "label", "v", "dim").toArrow()
    width = max(picked.column("dim").to_pylist(), default=0)
    sample = np.zeros((picked.num_rows, width), np.int64)
    for mine, part in _by_length(picked):
        values = whole(part.column("v"))
        sample[mine, : values.shape[1]] = values
    of = {c: np.asarray(picked.column(c)) for c in ("vec_id", "label", "dim")}
    tree = Tree.fit(sample.astype(np.float64), fanout, leaf_rows)

    # every row's leaf, kept: ranges and both searches must agree on it
    schema = StructType([*rows.schema.fields]).add("leaf", "long")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _by_length(batch):
                leaf = tree.leaves(whole(part.column("v")).astype(np.float64))
                yield from part.append_column("leaf", pa.array(leaf)).to_batches()

    placed = checkpointed(rows.mapInArrow(assign, schema))

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int, int], tuple[float, float]] = {}
        for batch in batches:
            for _, part in _by_length(batch):
                tree.ranges(whole(part.column("v")).astype(np.float64), np.asarray(part.column("leaf")), seen)
        columns = list(zip(*[(*k, *v) for k, v in seen.items()])) if seen else [()] * 5
        types = [pa.int64()] * 3 + [pa.float64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["node", "point", "subtree", "lo", "hi"])

    spans = placed.select("v", "dim", "leaf").mapInArrow(span, "node long, point long, subtree long, lo double, hi double")
    spans = spans.groupBy("node", "point", "subtree").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    tree.measured([tuple(r) for r in spans])

    leaf_sizes = checkpointed(placed.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("n_rows")))
    anchors = placed.filter("q").select(F.col("vec_id").alias("anchor_id"), F.col("row").alias("anchor_row"), "label", "dim", "v")

    def first(ids: np.ndarray, labels: np.ndarray, dim: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of the sample, and which of it is of the same length, not the anchor, and of its label."""
        scores = products(values, sample[:, : values.shape[1]]) if len(sample) else np.zeros((len(ids), 0), np.int64)
        other = (of["dim"] == dim)[None, :] & (of["vec_id"][None, :] != ids[:, None])
        return scores, other, of["label"][None, :] == labels[:, None]

    def seek_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _by_length(batch):
                values = whole(part.column("v"))
                scores, other, same = first(np.asarray(part.column("anchor_id")), np.asarray(part.column("label")), values.shape[1], values)
                bar = np.full((len(values), 1), -np.inf)
                for i in range(len(values)):
                    known = scores[i][other[i] & same[i]]
                    if len(known) >= positives:
                        bar[i] = np.partition(known, -positives)[-positives]
                yield from _found(part, tree.visits(values.astype(np.float64), _lower(bar), np.full_like(bar, np.inf)))

    def seek_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _by_length(batch):
                values = whole(part.column("v"))
                scores, other, same = first(np.asarray(part.column("anchor_id")), np.asarray(part.column("label")), values.shape[1], values)
                lo, hi = np.full((len(values), positives), np.inf), np.full((len(values), positives), -np.inf)
                for i, own in enumerate(part.column("positives").to_pylist()):
                    known = scores[i][other[i] & ~same[i]]
                    for w, positive in enumerate(own):
                        a, b = window(positive["score"], low, high)
                        inside = known[(known >= a) & (known <= b)]
                        lo[i, w], hi[i, w] = a, b
                        if len(inside) >= negatives:
                            lo[i, w] = np.partition(inside, -negatives)[-negatives]
                yield from _found(part, tree.visits(values.astype(np.float64), _lower(lo), hi))

    def tile_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            scores, other, same, ids = _tile(left, right)
            for i, key in enumerate(zip(left.column("anchor_id").to_pylist(), left.column("anchor_row").to_pylist())):
                out += [(*key, int(ids[j]), int(scores[i, j])) for j in best(scores[i], ids, other[i] & same[i], positives)]
        return _table(out, ["anchor_id", "anchor_row", "positive_id", "score"])

    def tile_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            scores, other, same, ids = _tile(left, right)
            rows_ = zip(left.column("anchor_id").to_pylist(), left.column("anchor_row").to_pylist(), left.column("positives").to_pylist())
            for i, (anchor, row, own) in enumerate(rows_):
                for w, positive in enumerate(own):
                    a, b = window(positive["score"], low, high)
                    allowed = other[i] & ~same[i] & (scores[i] >= a) & (scores[i] <= b)
                    for j in best(scores[i], ids, allowed, negatives):
                        out.append((anchor, row, w, positive["positive_id"], int(ids[j]), positive["score"], int(scores[i, j])))
        return _table(out, ["anchor_id", "anchor_row", "w", "positive_id", "negative_id", "positive_score", "negative_score"])

    def search(asking: DataFrame, seek, tile, out: str) -> DataFrame:
        visits = checkpointed(asking.mapInArrow(seek, StructType([*asking.schema.fields]).add("leaf", "long")))
        tiles = visits.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("n_asking")).join(fresh(leaf_sizes), ["dim", "leaf"])
        many = lambda c: F.ceil(F.col(c) / block).cast("int")
        tiles = checkpointed(tiles.select("dim", "leaf", many("n_asking").alias("abs"), many("n_rows").alias("rbs")))
        tiles = F.broadcast(tiles) if tiles.count() <= BROADCAST_LEAVES else tiles
        part = lambda by, *c: F.pmod(F.xxhash64(*c), F.col(by)).cast("int")
        every = lambda by: F.explode(F.sequence(F.lit(0), F.col(by) - 1))
        left = visits.join(tiles, ["dim", "leaf"]).select(
            "dim", "leaf", part("abs", "anchor_id", "anchor_row").alias("ab"), every("rbs").alias("rb"), *[c for c in asking.columns if c != "dim"]
        )
        right = placed.join(tiles, ["dim", "leaf"]).select(
            "dim", "leaf", every("abs").alias("ab"), part("rbs", "vec_id", "row").alias("rb"), "vec_id", "label", "v"
        )
        keys = ["dim", "leaf", "ab", "rb"]
        return left.groupBy(*keys).cogroup(fresh(right).groupBy(*keys)).applyInArrow(tile, out)

    found = search(anchors, seek_positives, tile_positives, "anchor_id long, anchor_row long, positive_id long, score long")
    order = W.partitionBy("anchor_id", "anchor_row").orderBy(F.col("score").desc(), "positive_id")
    top = found.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= positives)
    own = top.groupBy("anchor_id", "anchor_row").agg(F.array_sort(F.collect_list(F.struct("at", "positive_id", "score"))).alias("positives"))
    asking = checkpointed(anchors.join(fresh(own), ["anchor_id", "anchor_row"]).select(*anchors.columns, "positives"))
    found = search(
        asking, seek_negatives, tile_negatives,
        "anchor_id long, anchor_row long, w long, positive_id long, negative_id long, positive_score long, negative_score long",
    )
    order = W.partitionBy("anchor_id", "anchor_row", "w").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _lower(bar: np.ndarray) -> np.ndarray:
    """Bounds as doubles, none above the whole number it stands for."""
    return np.where(np.isfinite(bar), bar - np.abs(bar) * 2.0**-50, bar)


def _found(part: pa.Table, visits: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for leaf, mine in visits:
        yield from part.take(mine).append_column("leaf", pa.array(np.full(len(mine), leaf, np.int64))).to_batches()


def _tile(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scores of anchors and rows, which pairs differ in id, which share a label, and the rows' ids."""
    ids = np.asarray(right.column("vec_id"))
    other = np.asarray(left.column("anchor_id"))[:, None] != ids[None, :]
    same = np.asarray(left.column("label"))[:, None] == np.asarray(right.column("label"))[None, :]
    return products(whole(left.column("v")), whole(right.column("v"))), other, same, ids


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)
