"""Chunks of remove_repeats on skewed ids: cut by bytes, one id in several, none for rows without an id."""

import random
from collections import Counter

import numpy as np

from strata.llm import suffix_dedup
from tests.llm.test_text_ops import repeats_truth, words


def sizes(docs, rows, chunk_bytes):
    table = docs(rows).select("doc_id", "text")
    deal = suffix_dedup.dealer(table, sum(len(t) for _, t, *_ in rows), chunk_bytes)
    held = Counter()
    rng = np.random.default_rng(1)
    for i, t, *_ in rows:
        held[int(deal.chunk(np.array([i]), rng.integers(1 << 40, size=1))[0])] += len(t)
    return deal, held


def test_long_documents_make_no_large_chunk(spark, docs):
    # a tenth of the ids, next to each other, with texts of 100 times the length
    rows = [(i, "x" * (5000 if 900 <= i < 1000 else 50), None, None) for i in range(1000)]
    _, held = sizes(docs, rows, 20_000)
    assert max(held.values()) <= 40_000 and len(held) >= 20


def test_one_id_is_several_chunks(spark, docs):
    rows = [(i, "x" * 500, None, None) for i in range(100)] + [(50, "y" * 500, None, None) for _ in range(400)]
    deal, held = sizes(docs, rows, 10_000)
    assert max(held.values()) <= 20_000 and list(deal.order) == sorted(deal.order) and len(set(deal.order)) < len(deal.order)


def test_results_with_a_large_id_and_rows_without_one(spark, docs):
    rng = random.Random(5)
    shared = [" ".join(words(rng, 20)) for _ in range(6)]
    text = lambda: " ".join(words(rng, 12)) + rng.choice(shared) + " ".join(words(rng, 12))
    ones = [(i, text(), None, None) for i in range(0, 80, 2)]
    many = [(31, text() + f" {k}", None, None) for k in range(60)]
    none = [(None, rng.choice(shared) + str(k), None, None) for k in range(40)] + [(None, None, None, None)]
    rows = ones + many + none
    got = suffix_dedup.remove_repeats(docs(rows), chunk_bytes=1500, with_text=True, keep=["score"]).collect()
    assert len(got) == len(rows) and all(r.score == 0.5 for r in got)
    # each row of the large id by itself: nothing but earlier ids removes from it
    want = {}
    for i in {r[0] for r in ones + many}:
        for t in [t for j, t, *_ in ones + many if j == i]:
            want.setdefault(i, []).append(repeats_truth([r for r in ones + many if r[0] < i] + [(i, t)])[i])
    found = {}
    for r in got:
        if r.doc_id is not None:
            found.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    assert {i: sorted(x) for i, x in found.items()} == {i: sorted(x) for i, x in want.items()}
    left = [r for r in got if r.doc_id is None]
    assert sorted(r.kept_text for r in left) == sorted(t or "" for _, t, *_ in none) and not any(r.n_removed for r in left)
