"""Links of tables whose samples hold few of them, and of many vector lengths."""

import numpy as np

from strata.llm import multi_index


def made(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")


def test_recall_holds_where_the_sample_has_few_links(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 500)
    rng = np.random.default_rng(8)
    x = multi_index.unit(rng.normal(size=(3000, 64)))
    side = rng.normal(size=x.shape)
    side = multi_index.unit(side - (side * x).sum(1, keepdims=True) * x)
    y = 0.905 * x + (1 - 0.905**2) ** 0.5 * side
    rows = list(enumerate(np.concatenate([x, y])))
    got = {r.vec_id: r.n_links for r in multi_index.near_vectors(made(spark, rows), fit_rows=300).collect()}
    z = np.concatenate([x, y])
    true = int((z @ z.T >= 0.9).sum()) - len(z)
    assert true >= 6000 and sum(got.values()) / true >= 0.995


def test_every_vector_length_is_indexed(spark):
    rows = [(2 * d + k, np.arange(1, d + 1) * (1 + 0.01 * k * np.arange(d) / d)) for d in range(2, 92) for k in (0, 1)]
    got = multi_index.near_vectors(made(spark, rows)).collect()
    assert len(got) == 180 and all((r.n_links, r.component_id) == (1, r.vec_id // 2 * 2) for r in got)
