"""Spark SQL versions of the gold questions, and a parity check against the
DataFrame versions (multiset equality via ``same_rows``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.quality import same_rows


def q1_sql(db: str, lo: int = 2013, hi: int = 2018) -> str:
    return f"""
SELECT AVG(population) AS mean_population, STDDEV_POP(population) AS population_stddev
FROM {db}.silver_population WHERE year BETWEEN {lo} AND {hi}"""


def q2_sql(db: str, exact: bool = False) -> str:
    """The best years as those that equal the series' maximum; labels are put together once per series."""
    total = "CAST(SUM(CAST(value AS DECIMAL(38,15))) AS DOUBLE)" if exact else "SUM(value)"
    names = "sector_name, class_text, measure_text, duration_text, seasonal_text"
    return f"""
WITH totals AS (
  SELECT series_id, year, {total} AS total, MAX({total}) OVER (PARTITION BY series_id) AS most
  FROM {db}.silver_observations WHERE period BETWEEN 'Q01' AND 'Q04' GROUP BY series_id, year),
labels AS (
  SELECT series_id, {names}, concat_ws(' | ', {names}) AS series_description
  FROM {db}.silver_series
  LEFT JOIN {db}.silver_seasonal USING (seasonal_code) LEFT JOIN {db}.silver_duration USING (duration_code)
  LEFT JOIN {db}.silver_measure USING (measure_code) LEFT JOIN {db}.silver_class USING (class_code)
  LEFT JOIN {db}.silver_sector USING (sector_code))
SELECT t.series_id, t.year AS best_year, ROUND(t.total, 3) AS yearly_quarterly_sum,
       t.year = MAX(t.year) OVER (PARTITION BY t.series_id) AS is_latest_best_year,
       {names}, coalesce(series_description, '') AS series_description
FROM totals t LEFT JOIN labels USING (series_id) WHERE t.total = t.most"""


def q3_sql(db: str, series_id: str, period: str = "Q01") -> str:
    sid, per = series_id.replace("'", "''"), period.replace("'", "''")
    return f"""
SELECT o.year, o.series_id, o.period, o.value AS bls_value, p.population
FROM {db}.silver_observations o LEFT JOIN {db}.silver_population p ON o.year = p.year
WHERE o.series_id = '{sid}' AND o.period = '{per}'"""


def sql_parity(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    db: str,
    series_id: str = "PRS30006032",
    period: str = "Q01",
    years: tuple[int, int] = (2013, 2018),
    exact_sums: bool = False,
) -> dict[str, bool]:
    """Compare each published gold table with its SQL twin; True = same rows."""
    twins = {
        "gold_range_stats": q1_sql(db, *years),
        "gold_best_year": q2_sql(db, exact_sums),
        "gold_series_with_population": q3_sql(db, series_id, period),
    }
    return {name: same_rows(tables[name], spark.sql(sql)) for name, sql in twins.items()}
