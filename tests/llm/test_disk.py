"""Near-duplicate search lets finished shuffles go, and shingles little text at once."""

import random
import time
import tracemalloc

import pyarrow as pa

from strata.llm import common, minhash
from strata.llm.kernels import shingle_sets, slices, texts_of


def _live(spark, at_most=0):
    """Shuffles whose files Spark still keeps, once there are few enough or ten seconds have passed."""
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    for _ in range(20):
        if shuffles.size() <= at_most:
            break
        time.sleep(0.5)
    return shuffles.size()


def test_rounds_let_shuffles_go(spark):
    ids = list(range(10, 1010))
    random.Random(4).shuffle(ids)
    edges = common.checkpointed(spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long"))
    common.release(spark)
    time.sleep(2)
    before = _live(spark)
    got = common.components(edges)
    assert _live(spark, before + 16) <= before + 16  # the last round's own; without that, all of about ten rounds
    assert got.select("component").distinct().count() == 1


def test_shingling_is_bounded():
    texts = [" ".join(f"w{i}x{j}" for j in range(300)) for i in range(2000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    tracemalloc.start()
    n = sum(len(s) for part in slices(batch, "text", minhash.SLICE_BYTES) for s in shingle_sets(texts_of(part, "text")))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2000 * 296 and peak < 60e6
