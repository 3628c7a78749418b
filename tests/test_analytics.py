"""Best period with ties, range statistics, context joins, enrichment."""

import pytest
from pyspark.sql import functions as F

from strata.operators.analytics import best_period, range_stats, series_with_context
from strata.operators.enrich import DimSpec, describe, enrich
from strata.operators.latest import latest_by_key
from strata.operators.preview import preview
from strata.operators.ranking import top_with_ties

OBS = [
    ("S1", 2019, "Q01", 1.0), ("S1", 2019, "Q02", 2.0),
    ("S1", 2020, "Q01", 2.0), ("S1", 2020, "Q02", 1.0),  # 2019 and 2020 tie at 3.0
    ("S1", 2021, "Q01", 2.5), ("S1", 2021, "Q05", 100.0),  # Q05 (annual average) excluded
    ("S2", 2020, "Q01", 5.0),
]


def _obs(spark):
    return spark.createDataFrame(OBS, "series_id string, year int, period string, value double")


def test_best_period_keeps_ties_and_flags_latest(spark):
    best = best_period(_obs(spark), "series_id", "year", "value",
                       where=F.col("period").isin("Q01", "Q02", "Q03", "Q04"), period_col="best_year",
                       sum_col="s", flag_col="latest")
    got = sorted((r.series_id, r.best_year, r.s, r.latest) for r in best.collect())
    assert got == [("S1", 2019, 3.0, False), ("S1", 2020, 3.0, True), ("S2", 2020, 5.0, True)]


def test_exact_sums_keep_genuine_ties(spark):
    # 0.1+0.2+0.3 and 0.3+0.2+0.1 differ in double arithmetic; exact decimals tie.
    rows = [("S", 2000, v) for v in (0.1, 0.2, 0.3)] + [("S", 2001, v) for v in (0.3, 0.2, 0.1)]
    df = spark.createDataFrame(rows, "series_id string, year int, value double").coalesce(1)
    best = best_period(df, "series_id", "year", "value", exact=True, period_col="y", sum_col="s", flag_col="f")
    assert sorted(r.y for r in best.collect()) == [2000, 2001]


def test_min_count_drops_incomplete_years(spark):
    # A year with a single quarter can be excluded.
    best = best_period(_obs(spark), "series_id", "year", "value", where=F.col("period") != "Q05",
                       min_count=2, period_col="y", sum_col="s", flag_col="f")
    assert sorted((r.series_id, r.y) for r in best.collect()) == [("S1", 2019), ("S1", 2020)]


def test_range_stats_empty_and_single(spark):
    # No matching row -> one row of NULLs; one row -> stddev 0.
    df = spark.createDataFrame([(2013, 10.0), (2020, 20.0)], "year int, population double")
    none = range_stats(df, "population", "year", 2014, 2018).first()
    assert none.mean_value is None and none.stddev_value is None
    one = range_stats(df, "population", "year", 2013, 2018).first()
    assert one.mean_value == 10.0 and one.stddev_value == 0.0


def test_range_stats_values(spark):
    df = spark.createDataFrame([(y, float(p)) for y, p in [(2013, 1), (2014, 2), (2015, 3), (2019, 99)]],
                               "year int, population double")
    r = range_stats(df, "population", "year", 2013, 2018, "m", "sd").first()
    assert r.m == 2.0 and abs(r.sd - (2 / 3) ** 0.5) < 1e-12


def test_series_with_context_left_join(spark):
    obs = _obs(spark)
    pop = spark.createDataFrame([(2019, 100), (2021, 300)], "year int, population long")
    out = series_with_context(obs, pop, "year", "year", ["population"],
                              where=(F.col("series_id") == "S1") & (F.col("period") == "Q01"))
    got = sorted((r.year, r.population) for r in out.collect())
    assert got == [(2019, 100), (2020, None), (2021, 300)]


def test_enrich_snowflake_and_describe(spark):
    fact = spark.createDataFrame([("S1", 1.0), ("S9", 2.0)], "series_id string, v double")
    series = spark.createDataFrame([("S1", "A", "X")], "series_id string, sector_code string, class_code string")
    sector = spark.createDataFrame([("A", "Sector A")], "sector_code string, sector_name string")
    klass = spark.createDataFrame([("Y", "Class Y")], "class_code string, class_text string")
    out = enrich(fact, [
        DimSpec(series, "series_id", "series_id", ["sector_code", "class_code"]),
        DimSpec(sector, "sector_code", "sector_code", ["sector_name"]),
        DimSpec(klass, "class_code", "class_code", ["class_text"]),
    ]).withColumn("label", describe(["sector_name", "class_text"]))
    got = {r.series_id: (r.sector_name, r.class_text, r.label) for r in out.collect()}
    # NULL parts are skipped by the label, a missing series keeps its row.
    assert got == {"S1": ("Sector A", None, "Sector A"), "S9": (None, None, "")}


def test_exact_sums_lose_nothing(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("tiny", 2000, 0.0004)] * 4 + [("tiny", 2001, 0.0011)] + [("big", 2000, 1e16), ("big", 2001, 1e15), ("big", 2001, 1.0)]
    rows += [("huge", 2000, 1e30), ("huge", 2001, 3.0), ("inf", 2000, inf), ("inf", 2001, 5.0), ("nan", 2000, nan), ("nan", 2001, inf)]
    rows += [("fine", 2000, 1e-20), ("fine", 2001, 0.0), ("none", 2000, None), ("none", 2001, 1.0)]
    df = spark.createDataFrame(rows, "k string, y int, v double")
    for exact in (False, True):
        got = {r.k: (r.y, r.s) for r in best_period(df, "k", "y", "v", exact=exact, period_col="y", sum_col="s").collect()}
        assert got["tiny"][0] == 2000 and abs(got["tiny"][1] - 0.0016) < 1e-12
        assert got["big"] == (2000, 1e16) and got["huge"] == (2000, 1e30) and got["inf"] == (2000, inf)
        assert got["nan"][0] == 2000 and got["nan"][1] != got["nan"][1]
        assert got["fine"] == (2000, 1e-20) and got["none"] == (2001, 1.0)


def test_latest_by_key_and_top_with_ties(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 1), ("b", 1, 0)], "k string, t int, v int")
    assert sorted((r.k, r.t) for r in latest_by_key(df, ["k"], [F.col("t").desc()]).collect()) == [("a", 3), ("b", 1)]
    best = top_with_ties(df, ["k"], [F.col("v").desc()], F.col("t").desc(), "newest")
    assert sorted((r.k, r.t, r.newest) for r in best.collect()) == [("a", 1, False), ("a", 2, True), ("b", 1, True)]


def test_preview(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    rows = preview(df, [F.col("v").desc(), "id"], 3).collect()
    assert [(r.v, r.id) for r in rows] == [(6, 6), (6, 13), (6, 20)]


def test_preview_without_limit_or_order(spark):
    df = spark.range(5)
    assert [r.id for r in preview(df, [F.col("id").desc()], None).collect()] == [4, 3, 2, 1, 0]
    assert preview(df, n=3).count() == 3


def test_exact_moments_are_bit_equal_for_any_partitioning(spark):
    import random
    from fractions import Fraction

    from strata.operators.analytics import exact_moments

    rng = random.Random(2)
    cents = [rng.randrange(10**11, 10**11 + 5 * 10**4) for _ in range(3000)] + [-7, 0, 10**11]
    rows = [(c / 100, "a") for c in cents[:-3]] + [(c / 100, "b") for c in cents] + [(1e20, "c"), (1.0, "c"), (None, "d"), (2.5, "e"), (None, "e")]
    seen = set()
    for seed in range(4):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "v double, g string").repartition(1 + 3 * seed)
        got = {r.g: (r.mean_value, r.stddev_value) for r in exact_moments(df, ["g"], "v").collect()}
        seen.add(tuple(sorted((g, v) for g, v in got.items() if g in "abe")))
    assert len(seen) == 1
    for g, mine in (("a", cents[:-3]), ("b", cents)):
        values = [Fraction(c, 100) for c in mine]
        mean = sum(values) / len(values)
        variance = sum((x - mean) ** 2 for x in values) / len(values)
        assert got[g][0] == pytest.approx(float(mean), rel=1e-15)
        assert got[g][1] == pytest.approx(float(variance) ** 0.5, rel=1e-11)  # plain doubles lose about six digits here
    assert got["c"] == (5e19, 5e19) and got["d"] == (None, None) and got["e"] == (2.5, 0.0)


def test_exact_range_stats_matches_the_plain_one(spark):
    df = spark.createDataFrame([(y, float(100 * y + 7)) for y in range(2000, 2030)] + [(2013, None)], "year int, v double")
    plain, exact = (range_stats(df, "v", "year", 2010, 2020, exact=e).first() for e in (False, True))
    assert exact.mean_value == plain.mean_value and abs(exact.stddev_value - plain.stddev_value) < 1e-9
    nothing = range_stats(df, "v", "year", 1, 2, exact=True).collect()
    assert [tuple(r) for r in nothing] == [(None, None)]
