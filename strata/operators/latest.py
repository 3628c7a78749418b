"""Latest row per key (log reduction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__strata_rn"


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (e.g. ``[F.col("ts").desc()]``).

    ``order`` must end in a tie-breaker that is unique within a key, otherwise
    the chosen row is arbitrary among ties.

    Plan: ``row_number() = 1`` next to the window lets Catalyst insert a
    partial ``WindowGroupLimit`` before the shuffle, so every map task ships at
    most one row per key; a key holding a third of the log does not land whole
    in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
