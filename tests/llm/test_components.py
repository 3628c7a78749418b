"""Connected components on shapes that settle slowly."""

import random

from strata.llm.common import components


def test_shuffled_chain_settles(spark):
    ids = list(range(10, 3010))
    random.Random(4).shuffle(ids)
    # one chain, a star, a pair given both ways and twice, a loop
    rows = [(a, b) for a, b in zip(ids, ids[1:])] + [(9000, x) for x in range(8000, 8200)] + [(5000, 4999), (4999, 5000), (5000, 4999), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    want = {x: 10 for x in ids} | {x: 8000 for x in [*range(8000, 8200), 9000]} | {4999: 4999, 5000: 4999}
    assert got == want


def test_no_edges(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
