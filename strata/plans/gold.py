"""Gold-layer answers expressed over any fact/dimension tables.

``best_year_by_series`` is the library's flagship query: filter -> grouped sum
-> tie-keeping rank -> newest-tie flag -> snowflake enrichment -> label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.analytics import best_period
from strata.operators.cleanse import clean_columns
from strata.operators.enrich import DimSpec, describe, enrich
from strata.operators.quality import quality_gate
from strata.plans.medallion import NOT_NAN_RULE, OBSERVATION_RULES
from strata.schemas import OBSERVATIONS_RAW
from strata.sources.delimited import parse_delimited


def best_year_by_customer(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Per customer, the order year(s) with the highest total of fulfilled/open
    orders (exact decimal sums, ties kept, newest tied year flagged), labelled
    with segment, nation and region."""
    best = best_period(
        orders,
        "o_custkey",
        F.year("o_orderdate"),
        "o_totalprice",
        where=F.col("o_orderstatus").isin("F", "O"),
        exact=True,
        period_col="best_year",
        sum_col="yearly_sum",
        flag_col="is_latest_best_year",
    )
    enriched = enrich(
        best,
        [
            DimSpec(customer, "o_custkey", "c_custkey", ["c_mktsegment", "c_nationkey"]),
            DimSpec(nation, "c_nationkey", "n_nationkey", ["n_name", "n_regionkey"]),
            DimSpec(region, "n_regionkey", "r_regionkey", ["r_name"]),
        ],
    )
    return enriched.select(
        F.col("o_custkey").alias("series_id"),
        F.col("best_year").cast("int").alias("best_year"),
        F.round("yearly_sum", 3).alias("yearly_sum"),
        "is_latest_best_year",
        "n_name",
        "r_name",
        describe(["c_mktsegment", "n_name", "r_name"]).alias("series_description"),
    )


def best_year_from_raw_lines(lines: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Raw observation text -> typed silver rows behind the quality gate ->
    per series the best year over Q01-Q04 (exact sums, ties kept) -> labelled
    with the supplier's nation and region. Every step is row-local until the
    grouped sum, so the raw text is parsed where it is read."""
    raw = parse_delimited(lines, "line", OBSERVATIONS_RAW)
    silver = clean_columns(
        raw, {"series_id": None, "year": "int", "period": None, "value": "double", "footnote_codes": None}
    )
    kept, _ = quality_gate(silver, {**OBSERVATION_RULES, **NOT_NAN_RULE})
    best = best_period(
        kept,
        "series_id",
        "year",
        "value",
        where=F.col("period").isin("Q01", "Q02", "Q03", "Q04"),
        exact=True,
        period_col="best_year",
        sum_col="yearly_quarterly_sum",
        flag_col="is_latest_best_year",
    )
    series = supplier.select(
        F.concat(F.lit("PRS"), F.col("s_suppkey").cast("string")).alias("series_id"), "s_nationkey"
    )
    enriched = enrich(
        best,
        [
            DimSpec(series, "series_id", "series_id", ["s_nationkey"]),
            DimSpec(nation, "s_nationkey", "n_nationkey", ["n_name", "n_regionkey"]),
            DimSpec(region, "n_regionkey", "r_regionkey", ["r_name"]),
        ],
    )
    return enriched.select(
        "series_id",
        "best_year",
        F.round("yearly_quarterly_sum", 3).alias("yearly_quarterly_sum"),
        "is_latest_best_year",
        "n_name",
        "r_name",
        describe(["n_name", "r_name"]).alias("series_description"),
    )
