"""Best value per group with ties kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__strata_rank"
_TIE = "__strata_tie"


def top_with_ties(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    latest_by: Column | None = None,
    flag_col: str | None = None,
) -> DataFrame:
    """Rows ranked first per ``keys`` by ``order`` (``dense_rank() = 1``, so every tie stays).

    With ``latest_by`` and ``flag_col`` the tied rows are numbered by
    ``latest_by`` and ``flag_col`` is TRUE on the first one only.

    Both windows partition by the same keys, so the plan has one exchange;
    the rank filter becomes a ``WindowGroupLimit`` before that exchange.
    """
    ranked = df.withColumn(_RANK, F.dense_rank().over(Window.partitionBy(*keys).orderBy(*order)))
    best = ranked.filter(F.col(_RANK) == 1).drop(_RANK)
    if latest_by is None or flag_col is None:
        return best
    tie_order = Window.partitionBy(*keys).orderBy(latest_by)
    return best.withColumn(_TIE, F.row_number().over(tie_order)).withColumn(flag_col, F.col(_TIE) == 1).drop(_TIE)
