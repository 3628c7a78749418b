"""Analytical questions: range statistics, best period per series, series with yearly context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strata.operators.enrich import DimSpec, enrich
from strata.operators.ranking import top_with_ties


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_stats(
    df: DataFrame,
    value: str | Column,
    by: str | Column,
    lo,
    hi,
    mean_col: str = "mean_value",
    stddev_col: str = "stddev_value",
    where: Column | None = None,
    exact: bool = False,
) -> DataFrame:
    """Mean and population standard deviation of ``value`` where ``lo <= by <= hi``.

    One row always; NULLs when nothing matches, stddev 0 for a single row.
    ``exact`` takes both from exact sums (``exact_moments``): the same bits
    whatever the order and partitioning of the rows.
    Plan: partial aggregate per task, one tiny final merge. The range reaches
    the scan when ``by`` is a stored column; for a year of a date column give
    ``year_range`` of the date column as ``where``.
    """
    v = _col(value)
    rows = (df if where is None else df.filter(where)).filter(_col(by).between(lo, hi))
    if exact:
        return exact_moments(rows, [], v, mean_col, stddev_col)
    return rows.agg(F.avg(v).alias(mean_col), F.stddev_pop(v).alias(stddev_col))


#: Decimal places of the values that ``exact_moments`` sums exactly; below 10^14.
MOMENT_PLACES = 4


def exact_moments(
    df: DataFrame, keys: Sequence[str], value: str | Column, mean_col: str = "mean_value", stddev_col: str = "stddev_value"
) -> DataFrame:
    """Mean and population standard deviation per ``keys`` (of all rows without keys) from exact, mergeable sums.

    Values of at most four decimal places below 10^14 are summed, and so are
    their squares, as decimals: partial sums of any parts add up to the same
    sums. The deviations are taken from the mean rounded to four places, so that
    large values with small deviations lose nothing. A group with a value that
    does not fit, or whose sums overflow, has its plain double results.
    """
    v = _col(value)
    held = v.try_cast(f"decimal(18,{MOMENT_PLACES})")
    unheld = v.isNotNull() & ~F.coalesce(held.cast("double") == v.cast("double"), F.lit(False))
    sums = df.groupBy(*keys).agg(
        F.count(v).cast("decimal(20,0)").alias("__n"), F.coalesce(F.max(unheld), F.lit(False)).alias("__unheld"),
        F.try_sum(held).alias("__s"), F.try_sum(held * held).alias("__q"), F.avg(v).alias("__avg"), F.stddev_pop(v).alias("__dev"),
    )
    n, s = F.col("__n"), F.col("__s")
    center = sums.withColumn("__m", F.try_divide(s, n).cast(f"decimal(18,{MOMENT_PLACES})"))
    # the sum less n times the rounded mean; sum (x - m)^2 = q - m (s + rest)
    spread = center.withColumn("__rest", F.expr("try_subtract(__s, try_multiply(__n, __m))")).withColumn(
        "__d", F.expr("try_subtract(__q, try_multiply(__m, try_add(__s, __rest)))").cast("double")
    )
    count = n.cast("double")
    off = F.col("__rest").cast("double") / count
    deviation = F.sqrt(F.greatest(F.col("__d") / count - off * off, F.lit(0.0)))
    exact = ~F.col("__unheld") & F.col("__d").isNotNull() & (n > 0)
    return spread.select(
        *keys, F.when(exact, s.cast("double") / count).otherwise(F.col("__avg")).alias(mean_col),
        F.when(exact, deviation).otherwise(F.col("__dev")).alias(stddev_col),
    )


def year_range(column: str | Column, first: int, last: int) -> Column:
    """``first <= year(column) <= last`` as a half-open date range, which parquet scans can prune by."""
    c = _col(column)
    return (c >= F.make_date(F.lit(first), F.lit(1), F.lit(1))) & (c < F.make_date(F.lit(last + 1), F.lit(1), F.lit(1)))


#: Doubles that are whole in this unit are summed as longs by ``exact_sum``.
SUM_UNIT = 10_000
_WHOLE = float(2**53)  # whole numbers below this are doubles exactly
_LOW_BITS = 20


def exact_sum(rows: DataFrame, v: Column) -> Column:
    """The sum of ``v`` over a group, as a double, without a rounding before the last.

    Most values are whole numbers of ten thousandths: they are summed as longs, in
    a high and a low part that do not overflow. Others are summed as
    ``decimal(38, 15)``; only these pay for it. A group with a value that such a
    decimal cannot hold unchanged, or whose sums overflow, has its double sum.
    """
    kind = rows.select(v.alias("v")).schema["v"].dataType
    d = v.cast("double")
    units = d * F.lit(float(SUM_UNIT))
    whole = F.rint(units)
    known = not isinstance(kind, DecimalType) or kind.precision <= 15
    fits = F.coalesce((F.abs(units) < _WHOLE) & (whole / F.lit(float(SUM_UNIT)) == d), F.lit(False)) if known else F.lit(False)
    k = whole.cast("long")
    high = F.try_sum(F.when(fits, F.shiftright(k, _LOW_BITS)).otherwise(F.lit(0).cast("long")))
    low = F.try_sum(F.when(fits, k.bitwiseAND((1 << _LOW_BITS) - 1)).otherwise(F.lit(0).cast("long")))
    held = F.when(~fits, v.try_cast("decimal(38,15)"))
    unheld = ~fits & v.isNotNull() & ~F.coalesce(held.cast("double") == d, F.lit(False))
    some, other, plain = F.max(~fits & v.isNotNull()), F.try_sum(held), F.sum(d)
    units_sum = high.cast("decimal(20,0)") * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + low.cast("decimal(20,0)")
    exact = units_sum.cast("decimal(30,0)") * F.lit("0.0001").cast("decimal(4,4)")
    # a sum of units alone may be too large for fifteen places
    summed = F.when(some, F.try_add(exact.try_cast("decimal(38,15)"), other).cast("double")).otherwise(exact.cast("double"))
    return F.when(F.max(unheld) | plain.isNull(), plain).otherwise(F.coalesce(summed, plain))


def best_period(
    df: DataFrame,
    series: str,
    period: str | Column,
    value: str | Column,
    *,
    where: Column | None = None,
    exact: bool = False,
    min_count: int | None = None,
    period_col: str = "best_period",
    sum_col: str = "period_sum",
    flag_col: str = "is_latest_best",
) -> DataFrame:
    """Per ``series``, the period(s) with the largest sum of ``value``; ties kept,
    newest tied period flagged.

    By default values are summed as they are (doubles as double). ``exact``
    sums without rounding (``exact_sum``) so that equal totals rank equal whatever
    the row order, and returns the sum as double. A period that holds a value
    which a ``decimal(38, 15)`` cannot hold unchanged (more decimals, too large,
    NaN or infinite), or whose sum overflows it, falls back to its double sum as
    a whole: no value is rounded away or dropped. NaN ranks above infinity, and
    that above every number, in both modes.
    ``min_count`` drops periods with fewer rows.

    Plan: filter -> partial sum (map-side combine) -> exchange on
    (series, period) -> final sum -> exchange on series -> two windows sharing
    that partitioning. The second exchange carries one row per
    (series, period), so a series holding a third of all rows costs one row
    per period there.
    """
    rows = df if where is None else df.filter(where)
    v = _col(value)
    total = exact_sum(rows, v) if exact else F.sum(v)
    sums = rows.groupBy(F.col(series), _col(period).alias(period_col)).agg(
        total.alias(sum_col), F.count(F.lit(1)).alias("__strata_n")
    )
    if min_count is not None:
        sums = sums.filter(F.col("__strata_n") >= min_count)
    best = top_with_ties(
        sums.drop("__strata_n"),
        [series],
        [F.col(sum_col).desc()],
        latest_by=F.col(period_col).desc(),
        flag_col=flag_col,
    )
    return best.withColumn(sum_col, F.col(sum_col).cast("double"))


def series_with_context(
    series_df: DataFrame,
    context_df: DataFrame,
    series_key: str,
    context_key: str,
    context_cols: Sequence[str],
    *,
    where: Column | None = None,
) -> DataFrame:
    """Rows of ``series_df`` (optionally filtered) with context columns where a
    context row exists (left join on ``series_key = context_key``).

    The filter is applied before the join so it reaches the scan.
    """
    rows = series_df if where is None else series_df.filter(where)
    spec = DimSpec(context_df, series_key, context_key, list(context_cols))
    return enrich(rows, [spec])
