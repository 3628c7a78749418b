"""Raw -> Bronze -> Silver -> Gold on synthetic raw files with every edge row listed in FIXTURES.md."""

import json

import pytest
from pyspark.sql import functions as F

from strata.plans.medallion import run_medallion

HEADER_OBS = "series_id        \tyear\tperiod\tvalue\tfootnote_codes\n"
OBS_LINES = [
    # padded cells; two years tied for best (2019 and 2020 sum to 10.0)
    "PRS30006032   \t2019\tQ01\t   2.5\t",
    "PRS30006032\t2019\tQ02\t2.5\t",
    "PRS30006032\t2019\tQ03\t2.5\t",
    "PRS30006032\t2019\tQ04\t2.5\t",
    "PRS30006032\t2020\tQ01\t4.0\t",
    "PRS30006032\t2020\tQ02\t6.0\t",
    "PRS30006032\t2020\tQ05\t99.0\t",  # annual average: excluded from the sum
    "PRS30006032\t2018\tQ01\t1.0\t",
    "PRS30006032\t2021\tQ01\t3.0\t",  # year with one quarter only
    "PRS30006032\t2021\tQ02\t-\t",  # malformed number -> dropped
    "PRS30006032\t2021\tQ03\t\t",  # empty value -> dropped
    "PRS30006032\t2021\tM13\t9.0\t",  # period outside the five codes -> dropped
    "PRSMISSING\t2020\tQ01\t7.0\t",  # series missing from the dimension
    "PRS30006032\t2019\tQ04\tNaN\t",  # NaN: passes "value IS NOT NULL", rejected as not finite
]
SERIES = (
    "series_id\tsector_code\tclass_code\tmeasure_code\tduration_code\tseasonal\tbase_year\tfootnote_codes\t"
    "begin_year\tbegin_period\tend_year\tend_period\n"
    "PRS30006032  \t3000\t6\t03\t2\tS\t - \t\t1987\tQ01\t2024\tQ04\n"
)
DIMS = {
    "pr.sector": "sector_code\tsector_name\tdisplay_level\tselectable\tsort_sequence\n3000\tManufacturing\t0\tT\t1\n",
    "pr.class": "class_code\tclass_text\tdisplay_level\tselectable\tsort_sequence\n6\tAll workers\t0\tT\t1\n",
    "pr.measure": "measure_code\tmeasure_text\tdisplay_level\tselectable\tsort_sequence\n03\tHours\t0\tT\t2\n",
    "pr.duration": "duration_code\tduration_text\tdisplay_level\tselectable\tsort_sequence\n"
    "2\tPercent change\t0\tT\t2\n",
    "pr.seasonal": "seasonal_code\tseasonal_text\nS\tSeasonally Adjusted\n",
    "pr.period": "period\tperiod_abbr\tperiod_name\nQ01\tQTR1\t1st Quarter\n",
    "pr.footnote": "footnote_code\tfootnote_text\nR\tRevised\n",
    "pr.data.0.Current": HEADER_OBS + "PRS30006032\t2024\tQ01\t1.0\t\n",
}
POPULATION = {
    "columns": ["Nation ID", "Nation", "Year", "Population"],
    "data": [
        {"Nation ID": "01000US", "Nation": "United States", "Year": y, "Population": p}
        for y, p in [(2013, 316128839.0), (2014, 318857056.0), (2015, 321418821.0), (2016, 323127515.0),
                     (2017, 325719178.0), (2018, 327167439.0), (2019, 328239523.9)]
    ]
    + [
        {"Nation ID": "02000XX", "Nation": "Elsewhere", "Year": 2019, "Population": 5.0},  # second nation
        {"Nation ID": "01000US", "Nation": "United States", "Year": 2012, "Population": 0.0},  # non-positive
        {"Nation ID": "01000US", "Nation": " United States ", "Year": 2011, "Population": 3.0},  # padded name
    ],
}


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    series_root, ctx_root = root / "series", root / "ctx"
    series_root.mkdir()
    ctx_root.mkdir()
    (series_root / "pr.data.1.AllData").write_text(HEADER_OBS + "\n".join(OBS_LINES) + "\n")
    (series_root / "pr.series").write_text(SERIES)
    for name, text in DIMS.items():
        (series_root / name).write_text(text)
    (ctx_root / "population.json").write_text(json.dumps(POPULATION, indent=2))
    roots = str(series_root), str(ctx_root)
    plain = run_medallion(spark, *roots, database="medallion_plain")
    out = run_medallion(spark, *roots, database="medallion_test",
                         reject_nan=True, trim_before_gate=True, exact_sums=True)
    out.plain = plain
    out.roots = roots
    return out


def test_quality_counts(result):
    q = result.quality
    assert q["silver_observations"] == {"rows": 14, "failed_valid_observation": 3, "failed_not_nan": 1}
    assert q["silver_series"] == {"rows": 1, "failed_valid_series": 0}
    assert q["silver_population"] == {"rows": 10, "failed_valid_population": 2}


def test_silver_typing(result):
    s = result.tables["silver_series"].first()
    assert s.series_id == "PRS30006032" and s.base_year is None and s.begin_year == 1987
    assert s.seasonal_code == "S"
    pop = {r.year: r.population for r in result.tables["silver_population"].collect()}
    # The padded nation is trimmed before the gate, so it is kept, not silently lost.
    # Double -> long truncates toward zero in Spark (328239523.9 -> 328239523).
    assert pop[2011] == 3 and pop[2019] == 328239523 and 2012 not in pop


def test_gold_range_stats(result):
    r = result.tables["gold_range_stats"].first()
    vals = [316128839, 318857056, 321418821, 323127515, 325719178, 327167439]
    mean = sum(vals) / 6
    sd = (sum((v - mean) ** 2 for v in vals) / 6) ** 0.5
    assert abs(r.mean_population - mean) < 1e-6 and abs(r.population_stddev - sd) < 1e-6


def test_gold_best_year(result):
    rows = sorted(result.tables["gold_best_year"].collect(), key=lambda r: (r.series_id, r.best_year))
    got = [(r.series_id, r.best_year, r.yearly_quarterly_sum, r.is_latest_best_year) for r in rows]
    assert got == [("PRS30006032", 2019, 10.0, False), ("PRS30006032", 2020, 10.0, True), ("PRSMISSING", 2020, 7.0, True)]
    assert rows[0].series_description == "Manufacturing | All workers | Hours | Percent change | Seasonally Adjusted"
    assert rows[2].series_description == "" and rows[2].sector_name is None


def test_gold_series_with_population(result):
    got = sorted((r.year, r.bls_value, r.population) for r in result.tables["gold_series_with_population"].collect())
    assert got == [(2018, 1.0, 327167439), (2019, 2.5, 328239523), (2020, 4.0, None), (2021, 3.0, None)]


def test_tables_published(spark, result):
    names = {t.name for t in spark.catalog.listTables("medallion_test")}
    assert len([n for n in names if n.startswith("bronze_")]) == 11
    assert len([n for n in names if n.startswith("silver_")]) == 9
    assert len([n for n in names if n.startswith("gold_")]) == 3


def test_sql_twins_match_dataframe_gold(spark, result):
    from strata.plans.sql_twins import sql_parity

    assert sql_parity(spark, result.tables, "medallion_test", exact_sums=True) == {
        "gold_range_stats": True,
        "gold_best_year": True,
        "gold_series_with_population": True,
    }


def test_observations_partitioned_by_period(spark, result):
    import contextlib
    import io

    from strata.plans.medallion import gold_series_with_population

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        gold_series_with_population(
            result.tables["silver_observations"], result.tables["silver_population"], "PRS30006032"
        ).explain()
    assert "PartitionFilters: [isnotnull(period" in buf.getvalue() and "(period" in buf.getvalue()


def test_plain_run_keeps_what_the_rules_keep(spark, result):
    # by default NaN passes the validity rule, the nation is compared as stored, and sums are double
    plain = result.plain
    assert plain.quality["silver_observations"] == {"rows": 14, "failed_valid_observation": 3}
    assert plain.quality["silver_population"] == {"rows": 10, "failed_valid_population": 3}
    assert 2011 not in {r.year for r in plain.tables["silver_population"].collect()}
    best = {r.series_id: r.yearly_quarterly_sum for r in plain.tables["gold_best_year"].collect()}
    assert best["PRS30006032"] != best["PRS30006032"]  # the year with the NaN ranks first


def test_every_published_table_has_a_comment(spark, result):
    for t in spark.catalog.listTables("medallion_test"):
        assert spark.catalog.getTable(f"medallion_test.{t.name}").description, t.name


def test_bucketed_silver_needs_no_exchange_of_observations(spark, result, capsys):
    from strata.operators.quality import same_rows
    from strata.plans.medallion import gold_best_year

    out = run_medallion(spark, *result.roots, database="medallion_buckets", reject_nan=True, trim_before_gate=True, exact_sums=True, series_buckets=4)
    assert same_rows(out.tables["gold_best_year"], result.tables["gold_best_year"]) and out.quality == result.quality
    dims = [F.broadcast(out.tables[f"silver_{c}"]) for c in ("sector", "class", "measure", "duration", "seasonal")]
    gold_best_year(out.tables["silver_observations"], out.tables["silver_series"], *dims, exact=True).explain()
    plan = capsys.readouterr().out
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Bucketed: true" in plan
    # without buckets the sums are dealt once by series and year, and once by series
    gold_best_year(result.tables["silver_observations"], result.tables["silver_series"], *dims, exact=True).explain()
    assert "Exchange hashpartitioning" in capsys.readouterr().out


def test_lines_of_too_many_fields_are_counted_and_dropped(spark, result, tmp_path):
    import shutil

    series = tmp_path / "series"
    shutil.copytree(result.roots[0], series)
    with open(series / "pr.data.1.AllData", "a") as f:
        f.write("PRS30006032\t2021\tQ02\t9.0\t\tstray\n")
    out = run_medallion(spark, str(series), result.roots[1], database="medallion_extra", reject_nan=True, reject_extra_fields=True)
    assert out.quality["silver_observations"] == {"rows": 15, "failed_valid_observation": 3, "failed_not_nan": 1, "failed_no_extra_fields": 1}
    assert out.tables["silver_observations"].columns == result.tables["silver_observations"].columns
    assert out.tables["silver_observations"].count() == result.tables["silver_observations"].count()
