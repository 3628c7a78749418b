"""The packed sequences of the pipeline follow the mixture."""

import random

import corpus_pipeline
from strata.llm.queries import MIXTURE


def test_sequences_follow_the_weights(spark, docs):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    # as much of each named source, little of which the weights ask for; all the rest is "*"
    names = ["src0", "src1", "src2", "src3", "src4", "z", "z", "z", None]
    rows = [(i, " ".join(word() for _ in range(rng.randint(20, 1500))), "aa", names[i % 9]) for i in range(1800)]
    table = docs(rows).orderBy("doc_id")
    packed = corpus_pipeline.pack(spark, corpus_pipeline.mix(spark, table, ""), "").collect()
    source = {i: s if s in MIXTURE else "*" for i, _, _, s in rows}
    top = max(r.sequence_id for r in packed)
    assert {r.sequence_id for r in packed} == set(range(top + 1)) and {r.doc_id for r in packed} == set(source)
    shares = lambda lo, hi: {
        s: sum(r.length for r in packed if lo <= r.sequence_id < hi and source[r.doc_id] == s) / sum(r.length for r in packed if lo <= r.sequence_id < hi)
        for s in MIXTURE
    }
    for lo, hi in ((0, top // 4), (top // 8, 3 * top // 8)):
        got = shares(lo, hi)
        assert all(abs(got[s] - w / 100) < 0.04 for s, w in MIXTURE.items()), got
