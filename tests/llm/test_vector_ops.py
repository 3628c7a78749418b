"""Vector links and nearest neighbours against brute force."""

import numpy as np
import pytest

from strata.llm import knn_blocks, multi_index
from pyspark.sql import functions as F

BAD = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 0.5) for i, v in rows], "vec_id long, embedding array<float>, label int, score double")


def family(seed, n=400, groups=12, dim=16):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim)) for i in range(n)]
    for g in range(groups):
        center = rng.normal(size=dim)
        center /= np.linalg.norm(center)
        for k in range(rng.integers(2, 40)):
            rows.append((len(rows), center + rng.normal(size=dim) * rng.uniform(0.01, 0.06)))
    rows += [(len(rows) + k, rows[3][1]) for k in range(5)]
    rows += [(len(rows) + k, v) for k, v in enumerate(BAD)]
    return [(i, None if v is None else np.asarray([np.nan if x is None else x for x in v], np.float32) if len(v) and v[0] is not None else v) for i, v in rows]


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


@pytest.mark.parametrize("block", [40, 2000])
def test_links_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    rows = family(1)
    got = {r.vec_id: r for r in multi_index.near_vectors(table(spark, rows), words=8).collect()}
    good = [(i, np.asarray(v, float)) for i, v in rows if usable(v)]
    ids = np.array([i for i, _ in good])
    x = np.stack([v for _, v in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(link, label, 10**9).min(1))
        if (new == label).all():
            break
        label = new
    found, true = sum(got[i].n_links for i in ids), link.sum()
    assert true > 1000 and all(got[i].n_links <= n for i, n in zip(ids, link.sum(1)))
    assert found / true >= 0.98
    assert np.mean([got[i].component_id == c for i, c in zip(ids, label)]) > 0.99
    for i, v in rows:
        if not usable(v):
            assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
        assert got[i].kept == (got[i].component_id == i)


def test_links_edge_tables(spark):
    assert multi_index.near_vectors(table(spark, [(1, [1, 0])]).limit(0)).count() == 0
    got = multi_index.near_vectors(table(spark, [(None, [1, 0]), (4, [1, 0]), (5, [2, 0]), (6, [1, 0, 0]), (7, None)])).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in got) == [(0, 0, 0, False), (4, 1, 4, True), (5, 1, 4, False), (6, 0, 6, True), (7, 0, 7, True)]


def test_visits_follow_the_sum_order():
    rng = np.random.default_rng(3)
    x = multi_index.unit(rng.normal(size=(200, 10)))
    grid = multi_index.Grid(x, words=6)
    d = multi_index.distances(x[:, :5], grid.books[0])[:, :, None] + multi_index.distances(x[:, 5:], grid.books[1])[:, None, :]
    best = np.sort(d.reshape(200, -1), 1)[:, :9]
    got = np.take_along_axis(d.reshape(200, -1), grid.visits(x, 9).astype(int), 1)
    assert np.allclose(got, best)


@pytest.mark.parametrize("blocks", [(7, 30), (4096, 4096)])
def test_nearest_equals_brute_force(spark, blocks):
    rows = family(2)
    got = {}
    for r in knn_blocks.nearest(table(spark, rows), F.pmod("vec_id", F.lit(10)) == 0, query_block=blocks[0], candidate_block=blocks[1]).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = {i: np.asarray(v, float) for i, v in rows if usable(v)}
    for q in [i for i in good if i % 10 == 0]:
        scores = [(float(good[q] @ v / (np.linalg.norm(good[q]) * np.linalg.norm(v))), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
        best = sorted(scores, key=lambda s: (-round(s[0], 12), s[1]))[:5]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert [m[1] for m in mine] == [i for _, i in best]
        assert np.allclose([m[2] for m in mine], [s for s, _ in best], atol=1e-12)
    assert set(got) == {i for i in good if i % 10 == 0}


def test_nearest_few_candidates(spark):
    rows = [(0, [1, 0]), (1, [0, 1]), (2, [1, 1]), (0, [1, 0]), (None, [1, 0]), (3, None)]
    got = knn_blocks.nearest(table(spark, rows), F.pmod("vec_id", F.lit(50)) == 0).collect()
    assert sorted({(r.query_id, r.vec_id) for r in got}) == [(0, 1), (0, 2)]
    assert knn_blocks.nearest(table(spark, rows).limit(0), F.lit(True)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, y = multi_index.unit(rng.normal(size=(50, 64))), multi_index.unit(rng.normal(size=(60, 64)))
    (a, sa, ra), (b, sb, rb) = knn_blocks.quantised(x), knn_blocks.quantised(y)
    near = (a.astype(float) @ b.astype(float).T) * sa[:, None] * sb[None]
    assert (np.abs(near - x @ y.T) <= ra[:, None] + (1 + ra[:, None]) * rb[None] + 1e-12).all()


@pytest.mark.parametrize("scale", [1e200, 1e-200, 3e-310, 1.0])
def test_neighbours_of_extreme_components(spark, scale):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(30, 6))
    rows = [(i, [float(x) for x in v * (scale if i % 2 else 1.0)]) for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in knn_blocks.nearest(df, F.col("vec_id") % 10 == 0, 3).collect()]
    x = base / np.linalg.norm(base, axis=1, keepdims=True)
    for query in (0, 10, 20):
        order = sorted((c for c in range(30) if c != query), key=lambda c: -(x[query] @ x[c]))[:3]
        mine = sorted(r[1:] for r in got if r[0] == query)
        assert [r[1] for r in mine] == order
        assert all(abs(r[2] - x[query] @ x[r[1]]) < (1e-12 if scale != 3e-310 else 1e-3) for r in mine)
