"""remove_repeats holds one Python worker a task and sorts names range by range."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import suffix_dedup as sd


def asked(names):
    n = len(names)
    return pa.table({"bucket": pa.array([3] * n, pa.int32()), "chunk": pa.array(range(n), pa.int32()), "names": pa.array([sd.packed(x) for x in names], pa.binary())})


def peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_no_task_of_the_bounds_runs_two_python_steps(docs, monkeypatch):
    seen, bounds = [], sd._bounds
    monkeypatch.setattr(sd, "_bounds", lambda ids, count: seen.append(ids) or bounds(ids, count))
    table = docs([(i, "x" * 100, None, None) for i in range(400)]).select("doc_id", "text")
    assert len(sd.dealer(table, 40_000, 2_000).bounds) >= 10
    assert ["InArrow" in x._jdf.queryExecution().executedPlan().toString() for x in seen] == [False]


def test_a_bucket_takes_little_beside_its_names():
    rng = np.random.default_rng(1)
    table = asked([np.unique(rng.integers(0, 1 << 36, 12_000, dtype=np.uint64)) for _ in range(128)])
    held = 8 * 128 * 12_000
    assert peak(lambda: sd._bucket_reply(sd.EARLIER, np.arange(128, dtype=np.int32))(table)) < 5 * held


def test_a_chunk_takes_little_beside_its_text():
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 123, 2000, dtype=np.uint8).tobytes().decode() for _ in range(2000)]
    told = pa.table([pa.array([], f) for f in (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())], names=sd._REPLY.names)
    chunk = sd.Chunk(pa.table({"doc_id": pa.array(range(2000), pa.int64()), "text": pa.array(texts)}), told, 50, 40, 80)
    sd._powers.cache_clear()
    assert peak(chunk.cover_names) < 16 * 2000 * 2000


@pytest.mark.parametrize("sort_names", [1, 7, 1 << 18])
def test_ranges_change_nothing(monkeypatch, sort_names):
    monkeypatch.setattr(sd, "SORT_NAMES", sort_names)
    rng = np.random.default_rng(3)
    name, rank = rng.integers(0, 90, 300, dtype=np.uint64) << np.uint64(56), rng.integers(0, 50, 300).astype(np.int32)
    ranks = {n: [int(r) for m, r in zip(name.tolist(), rank) if m == n] for n in name.tolist()}
    got = sd.distinct(name, rank)
    assert list(zip(*(x.tolist() for x in got))) == [(n, min(r), max(r)) for n, r in sorted(ranks.items())]
    assert [len(x) for x in sd.distinct(name[:0], rank[:0])] == [0, 0, 0]

    names = [np.unique(rng.integers(0, 60, 15, dtype=np.uint64)) for _ in range(8)]
    order = np.array([0, 0, 1, 2, 2, 3, 4, 5], np.int32)
    for kind in (sd.SHARED, sd.EARLIER):
        said = {r["chunk"]: np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in sd._bucket_reply(kind, order)(asked(names)).to_pylist()}
        for c, own in enumerate(names):
            others = [order[d] < order[c] if kind == sd.EARLIER else d != c for d in range(8)]
            # two chunks of one large id count as one owner, but each asks for itself
            want = [any(o and n in names[d].tolist() for d, o in enumerate(others)) for n in own.tolist()]
            assert said.get(c, np.zeros(len(own)))[: len(own)].tolist() == want
