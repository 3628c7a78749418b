"""Raw -> Bronze -> Silver -> Gold for productivity time series with a yearly
population context.

Each layer is published as a table and the next layer reads the published
table, so a failure (or a lost executor) re-runs from the last written layer,
not from the raw files. No layer collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import schemas as S
from strata.operators.analytics import best_period, range_stats, series_with_context
from strata.operators.cleanse import clean_columns
from strata.operators.enrich import DimSpec, describe, enrich
from strata.operators.quality import assert_unique, observed_gate
from strata.plans.publish import publish, publish_together
from strata.sources.delimited import NO_EXTRA_FIELDS, read_delimited
from strata.sources.json_records import read_json_records


@dataclass(frozen=True)
class RawSpec:
    """A raw dataset: file under a root, its fixed schema and reader kind."""

    name: str
    root: str  # "series" (tab-separated text root) or "context" (JSON root)
    file: str
    schema: StructType
    kind: str = "delimited"
    comment: str = ""


# Fixed file names of the raw layout.
BRONZE_SPECS = (
    RawSpec("bronze_series", "series", "pr.series", S.SERIES_RAW, comment="Raw series metadata."),
    RawSpec("bronze_class", "series", "pr.class", S.CLASS_RAW, comment="Raw worker class codes."),
    RawSpec("bronze_duration", "series", "pr.duration", S.DURATION_RAW, comment="Raw duration codes."),
    RawSpec("bronze_footnote", "series", "pr.footnote", S.FOOTNOTE_RAW, comment="Raw footnotes."),
    RawSpec("bronze_measure", "series", "pr.measure", S.MEASURE_RAW, comment="Raw measure codes."),
    RawSpec("bronze_period", "series", "pr.period", S.PERIOD_RAW, comment="Raw period codes."),
    RawSpec("bronze_seasonal", "series", "pr.seasonal", S.SEASONAL_RAW, comment="Raw seasonal codes."),
    RawSpec("bronze_sector", "series", "pr.sector", S.SECTOR_RAW, comment="Raw sector codes."),
    RawSpec("bronze_current", "series", "pr.data.0.Current", S.OBSERVATIONS_RAW, comment="Raw current observations."),
    RawSpec("bronze_all_data", "series", "pr.data.1.AllData", S.OBSERVATIONS_RAW, comment="Raw observations."),
    RawSpec(
        "bronze_population", "context", "population.json", S.POPULATION_DOCUMENT, "json", "Raw population records."
    ),
)

# Quality rules (fixed). A row is kept only when its rule is TRUE.
# Period codes: Q01-Q04 are quarters, Q05 is the annual average (not a quarter).
QUARTERS = ("Q01", "Q02", "Q03", "Q04")
OBSERVATION_RULES = {
    "valid_observation": "series_id IS NOT NULL AND year IS NOT NULL "
    "AND period IN ('Q01', 'Q02', 'Q03', 'Q04', 'Q05') AND value IS NOT NULL",
}
SERIES_RULES = {"valid_series": "series_id IS NOT NULL"}
# "NaN" text casts to NaN, which passes "value IS NOT NULL" and ranks above
# every number. This rule, off by default, drops and counts such rows.
NOT_NAN_RULE = {"not_nan": "NOT isnan(value)"}

SILVER_COMMENTS = {
    "silver_observations": "Typed observations with a series, year, known period and value.",
    "silver_measure": "Measure codes and texts.",
    "silver_sector": "Sector codes and names.",
    "silver_class": "Worker class codes and texts.",
    "silver_duration": "Duration codes and texts.",
    "silver_seasonal": "Seasonal adjustment codes and texts.",
    "silver_period": "Period codes and names.",
    "silver_series": "Series with their codes and first and last period.",
    "silver_population": "Yearly population of one nation.",
}
GOLD_COMMENTS = {
    "gold_range_stats": "Mean and standard deviation of the population over a range of years.",
    "gold_best_year": "Per series the year of the largest quarterly sum, ties kept.",
    "gold_series_with_population": "One series and period with the year's population.",
}


def population_rules(nation: str) -> dict[str, str]:
    quoted = nation.replace("'", "''")
    return {"valid_population": f"nation = '{quoted}' AND year IS NOT NULL AND population > 0"}


def load_bronze(
    spark: SparkSession, series_root: str, context_root: str, specs=BRONZE_SPECS, extra_col: str | None = None
) -> dict[str, DataFrame]:
    """Lazy raw readers for every spec (text: header + fixed schema; JSON: exploded, sanitised).

    ``extra_col`` keeps what observations hold beyond their schema (``read_delimited``).
    """
    roots = {"series": series_root.rstrip("/"), "context": context_root.rstrip("/")}
    out = {}
    for s in specs:
        path = f"{roots[s.root]}/{s.file}"
        if s.kind == "json":
            out[s.name] = read_json_records(spark, path, s.schema, "data")
        else:
            out[s.name] = read_delimited(spark, path, s.schema, extra_col=extra_col if s.schema is S.OBSERVATIONS_RAW else None)
    return out


def _dim(df: DataFrame, code: str, text: str) -> DataFrame:
    return clean_columns(
        df, {code: None, text: None, "display_level": "int", "selectable": None, "sort_sequence": "int"}
    )


@dataclass
class Silver:
    """Silver frames (lazy) and the quality observations of the gated ones."""

    tables: dict[str, DataFrame]
    rules: dict[str, Mapping[str, str]] = field(default_factory=dict)
    after: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)  # applied to gated rows


def build_silver(
    bronze: Mapping[str, DataFrame], nation: str = "United States", reject_nan: bool = False, trim_before_gate: bool = False
) -> Silver:
    """Trimmed, typed (``try_cast``) silver frames; the gated ones are returned
    ungated here with their rules, so ``run_medallion`` can count drops while writing.
    ``reject_nan`` also drops NaN observations, which the plain validity rule
    keeps. The nation is compared as stored and trimmed afterwards;
    ``trim_before_gate`` trims it first, so that padded names are kept. Observations
    read with ``extra_fields`` are gated by them too."""
    raw = bronze["bronze_all_data"]
    ragged = "extra_fields" in raw.columns
    obs = clean_columns(
        raw,
        {"series_id": None, "year": "int", "period": None, "value": "double", "footnote_codes": None},
        keep=["extra_fields"] if ragged else [],
    )
    series = clean_columns(
        bronze["bronze_series"],
        {
            "series_id": None, "sector_code": None, "class_code": None, "measure_code": None,
            "duration_code": None, "seasonal": None, "base_year": "int", "footnote_codes": None,
            "begin_year": "int", "begin_period": None, "end_year": "int", "end_period": None,
        },
        rename={"seasonal": "seasonal_code"},
        null_tokens={"base_year": ["-"]},
    )
    trimmed = lambda df: df.withColumn("nation", F.trim("nation"))
    population = bronze["bronze_population"].select(
        F.trim("nation").alias("nation") if trim_before_gate else F.col("nation"),
        F.trim("nation_id").alias("nation_id"),
        F.col("year").try_cast("int").alias("year"),
        F.col("population").try_cast("long").alias("population"),
    )
    tables = {
        "silver_observations": obs,
        "silver_measure": _dim(bronze["bronze_measure"], "measure_code", "measure_text"),
        "silver_sector": _dim(bronze["bronze_sector"], "sector_code", "sector_name"),
        "silver_class": _dim(bronze["bronze_class"], "class_code", "class_text"),
        "silver_duration": _dim(bronze["bronze_duration"], "duration_code", "duration_text"),
        "silver_seasonal": clean_columns(bronze["bronze_seasonal"], {"seasonal_code": None, "seasonal_text": None}),
        "silver_period": clean_columns(
            bronze["bronze_period"], {"period": None, "period_abbr": None, "period_name": None}
        ),
        "silver_series": series,
        "silver_population": population,
    }
    rules = {
        "silver_observations": OBSERVATION_RULES | (NOT_NAN_RULE if reject_nan else {}) | (NO_EXTRA_FIELDS if ragged else {}),
        "silver_series": SERIES_RULES,
        "silver_population": population_rules(nation),
    }
    after = {} if trim_before_gate else {"silver_population": trimmed}
    if ragged:
        after["silver_observations"] = lambda df: df.drop("extra_fields")
    return Silver(tables, rules, after)


def gold_range_stats(population: DataFrame, lo: int = 2013, hi: int = 2018) -> DataFrame:
    """Question 1: mean and population stddev of population over [lo, hi]."""
    return range_stats(population, "population", "year", lo, hi, "mean_population", "population_stddev")


def gold_best_year(
    observations: DataFrame,
    series: DataFrame,
    sector: DataFrame,
    klass: DataFrame,
    measure: DataFrame,
    duration: DataFrame,
    seasonal: DataFrame,
    periods=QUARTERS,
    exact: bool = False,
) -> DataFrame:
    """Question 2: per series the year(s) with the highest sum over ``periods``
    (annual-average code excluded), ties kept, newest tied year flagged, labelled.
    Sums are double and only the result is rounded; ``exact`` as in ``best_period``."""
    best = best_period(
        observations,
        "series_id",
        "year",
        "value",
        where=F.col("period").isin(*periods),
        exact=exact,
        period_col="best_year",
        sum_col="yearly_quarterly_sum",
        flag_col="is_latest_best_year",
    )
    codes = ["sector_code", "class_code", "measure_code", "duration_code", "seasonal_code"]
    enriched = enrich(
        best,
        [
            DimSpec(series, "series_id", "series_id", codes),
            DimSpec(sector, "sector_code", "sector_code", ["sector_name"]),
            DimSpec(klass, "class_code", "class_code", ["class_text"]),
            DimSpec(measure, "measure_code", "measure_code", ["measure_text"]),
            DimSpec(duration, "duration_code", "duration_code", ["duration_text"]),
            DimSpec(seasonal, "seasonal_code", "seasonal_code", ["seasonal_text"]),
        ],
    )
    labels = ["sector_name", "class_text", "measure_text", "duration_text", "seasonal_text"]
    return enriched.select(
        "series_id",
        "best_year",
        F.round("yearly_quarterly_sum", 3).alias("yearly_quarterly_sum"),
        "is_latest_best_year",
        *labels,
        describe(labels).alias("series_description"),
    )


def gold_series_with_population(
    observations: DataFrame, population: DataFrame, series_id: str, period: str = "Q01"
) -> DataFrame:
    """Question 3: one series in one period, with the year's population where known."""
    where: Column = (F.col("series_id") == series_id) & (F.col("period") == period)
    out = series_with_context(
        observations, population.select("year", "population"), "year", "year", ["population"], where=where
    )
    # Output column names are fixed values of the published question-3 table.
    return out.select("year", "series_id", "period", F.col("value").alias("bls_value"), "population")


#: Code tables of at most this many rows, counted from their file footers, are broadcast by ``run_medallion``.
CODE_ROWS = 10_000


def _small(codes: DataFrame) -> DataFrame:
    return F.broadcast(codes) if codes.count() <= CODE_ROWS else codes


@dataclass
class MedallionResult:
    tables: dict[str, DataFrame]
    quality: dict[str, dict[str, int]]


def run_medallion(
    spark: SparkSession,
    series_root: str,
    context_root: str,
    *,
    database: str = "default",
    nation: str = "United States",
    series_id: str = "PRS30006032",
    period: str = "Q01",
    years: tuple[int, int] = (2013, 2018),
    check_unique_context: bool = True,
    reject_nan: bool = False,
    trim_before_gate: bool = False,
    exact_sums: bool = False,
    reject_extra_fields: bool = False,
    series_buckets: int | None = None,
) -> MedallionResult:
    """Publish bronze, silver and gold tables in order; return them and the
    per-rule drop counts gathered while the silver tables were written.

    ``reject_extra_fields`` drops and counts observation lines of more fields than
    the layout has; without it the fields beyond are passed by. ``series_buckets``
    deals observations and series into that many buckets by series, so that the
    sums by series and year and the join with the series need no exchange; leave
    it off where one series holds a large share of the observations."""
    db = lambda n: f"{database}.{n}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out: dict[str, DataFrame] = {}
    raw = load_bronze(spark, series_root, context_root, extra_col="extra_fields" if reject_extra_fields else None)
    comments = {s.name: s.comment for s in BRONZE_SPECS}

    def layer(jobs: dict[str, Callable[[], DataFrame]]) -> None:
        """Tables that do not read each other, published side by side."""
        out.update(zip(jobs, publish_together(spark, jobs.values())))

    layer({name: (lambda name=name, df=df: publish(df, db(name), comments[name])) for name, df in raw.items()})

    silver = build_silver(out, nation, reject_nan, trim_before_gate)
    # Observations by period code (five values): question 3 reads one folder,
    # question 2 skips the annual-average folder.
    layout = {"silver_observations": ("period",)}
    buckets = dict.fromkeys(("silver_observations", "silver_series"), (series_buckets, "series_id")) if series_buckets else {}
    frames, counted = {}, {}
    for name, df in silver.tables.items():
        if rules := silver.rules.get(name):
            kept, counted[name] = observed_gate(df, rules, f"{database}_{name}")
            df = silver.after.get(name, lambda df: df)(kept)
        frames[name] = df
    layer({
        name: (lambda name=name, df=df: publish(df, db(name), SILVER_COMMENTS[name], partition_by=layout.get(name, ()), bucket_by=buckets.get(name)))
        for name, df in frames.items()
    })
    quality = {name: {k: int(v) for k, v in obs.get.items()} for name, obs in counted.items()}

    population = out["silver_population"]
    if check_unique_context:
        assert_unique(population, ["year"], "silver_population")
    gold = {
        "gold_range_stats": gold_range_stats(population, *years),
        "gold_best_year": gold_best_year(
            out["silver_observations"], out["silver_series"],
            *[_small(out[f"silver_{code}"]) for code in ("sector", "class", "measure", "duration", "seasonal")], exact=exact_sums,
        ),
        "gold_series_with_population": gold_series_with_population(out["silver_observations"], population, series_id, period),
    }
    layer({name: (lambda name=name, df=df: publish(df, db(name), GOLD_COMMENTS[name])) for name, df in gold.items()})
    return MedallionResult(out, quality)
