"""URL filter, mixing and sharding: laws, edge cases, plans without Python."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing, sharding, url_filter

ALLOW, BLOCK = ["com/", "www.example.com/en/"], ["example.com/en/", "net/es/", "net/fr/"]


def plan(df):
    return df._jdf.queryExecution().toString()


# ---------------------------------------------------------------- URL filter
URLS = [
    "http://www.Example.com/en/1", "https://a.example.com/en/x?q=1", "http://example.com/de/#f", "http://EXAMPLE.com", "x.net/es/1",
    "https://b.net/es/2", "https://bnet/es/2", "http://net/fr/", "ftp://u@h.org:80/a?b#c", None, "", "://", "http://a.com?x/en/", "a://b://c/d",
    "http://ÄÖ.com/é", "http://a.com/" + "x" * 20000, "http://a.com/\nen", "http://notcom/",
]


def judged(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"(?s)[^/?#]*", rest).group()
    path = re.match(r"(?s)[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in ALLOW + BLOCK if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len, default=None)


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "html", "v") for i, u in enumerate(URLS)], "page_id long, url string, html string, verdict string")
    for r in url_filter.filter_urls(pages, ALLOW, BLOCK).collect():
        host, path, rule = judged(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block")
        if rule:
            assert r.verdict == ("allow" if rule in ALLOW else "block")


def test_url_model_separates_and_stays_native(spark):
    rng = random.Random(1)
    good = [("good%d.org" % rng.randrange(99), "/news/%d" % rng.randrange(99), 0) for _ in range(200)]
    bad = [("spam-pills%d.org" % rng.randrange(99), "/buy/%d" % rng.randrange(99), 1) for _ in range(200)]
    labelled = spark.createDataFrame(good + bad, "host string, path string, label int")
    pages = spark.createDataFrame([(1, "http://good7.org/news/3"), (2, "http://spam-pills5.org/buy/1"), (2, "http://spam-pills5.org/buy/1")], "page_id long, url string")
    out = url_filter.filter_urls(pages, [], [], labelled)
    assert sorted((r.page_id, r.verdict) for r in out.collect()) == [(1, "allow"), (2, "block"), (2, "block")]
    assert "Python" not in plan(out) and "Arrow" not in plan(out)


def test_url_empty_and_unlabelled(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(none, ALLOW, BLOCK).count() == 0
    one = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    assert url_filter.filter_urls(one, ALLOW, BLOCK).first().verdict == "allow"


# -------------------------------------------------------------------- mixing
def test_period_meets_every_window():
    for seed in range(20):
        rng = random.Random(seed)
        units = {f"s{i}": rng.randint(1, 15) for i in range(rng.randint(1, 12))}
        total = sum(units.values())
        period = mixing.pfair_period(units)
        assert sorted(t for b in period.values() for t, _, _ in b) == list(range(total))
        for s, u in units.items():
            assert len(period[s]) == u
            assert all(release <= t < deadline for t, release, deadline in period[s])
            for upto in range(total + 1):  # less than one block off at every boundary
                done = sum(t < upto for t, _, _ in period[s])
                assert abs(done * total - upto * u) < total


def test_mixture_law_over_rows(spark, docs):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randrange(0, 400), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    rows += [(None, None, None, "a"), (7, "dup", None, "b"), (7, "dup", None, "b")]
    weights, block = {"a": 5, "b": 3, "*": 2}, 512
    table = docs(rows)
    mixed = mixing.mix_sources(table, weights, block)
    placed = mixing.stream_positions(mixed, weights, block)
    got = sorted(placed.collect(), key=lambda r: r.mix_position)
    assert [r.mix_position for r in got] == list(range(len(rows)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got) == sorted((i is None, i or 0, t or "") for i, t, _, _ in rows)
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in got)
    left = {c: sum(r.mix_size for r in got if r.mix_class == c) for c in ("a", "b", "*")}
    done = dict.fromkeys(left, 0)
    slot = 0
    for r in got:
        if r.mix_slot > slot and all(done[c] < left[c] for c in left):
            for c, u in weights.items():  # one block, plus the row that crosses the boundary
                assert abs(done[c] - r.mix_slot * u / 10 * block) < block + 401
            slot = r.mix_slot
        done[r.mix_class] += r.mix_size
    assert "Python" not in plan(placed) and "Arrow" not in plan(placed)
    assert mixing.mix_sources(docs([(1, "t", "en", "a")]).limit(0), weights).count() == 0
    with pytest.raises(ValueError):
        mixing.pfair_period({"a": 0})


# ------------------------------------------------------------------ sharding
@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 9, 50, 1000, 4099])
def test_shards_are_even_and_gapless(spark, n):
    table = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("é").alias("text"), F.lit(1).alias("slot"))
    got = sharding.shard_rows(table).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (3, zlib.crc32("é".encode()), "rows", None)
    assert len(got) == n and all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(k, [])) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_shuffle_and_edge_rows(spark, docs):
    table = docs([(i, f"t{i}", "en", "a") for i in range(400)] + [(None, None, None, None), (3, "t3", "en", "a"), (3, "t3", "en", "a"), (9, "", None, None)])
    first, again = (sorted(map(tuple, sharding.shard_rows(table).collect()), key=str) for _ in range(2))
    assert first == again and len(first) == 404
    empty = [r for r in first if r[1] == 1]
    assert len(empty) == 2 and all(r[2] == 0 for r in empty)
    order = [r[0] for r in sorted(first, key=lambda r: (r[5], r[4])) if r[0] is not None]
    assert order != sorted(order)
    assert "Python" not in plan(sharding.shard_rows(table)) and "Arrow" not in plan(sharding.shard_rows(table))


def test_places_are_a_permutation(spark):
    for n in (1, 5, 16, 17, 99, 1000):
        places = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 4)).collect()]
        assert sorted(places) == list(range(n))
