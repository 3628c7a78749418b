"""Ordered previews (top-k)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def preview(df: DataFrame, order: Sequence[str | Column] = (), n: int | None = 20) -> DataFrame:
    """First ``n`` rows under ``order``; plans as ``TakeOrderedAndProject`` (per-task top-n, no full sort).

    ``n=None`` gives the whole frame in order; no ``order`` gives any ``n`` rows.
    """
    ordered = df.orderBy(*order) if order else df
    return ordered if n is None else ordered.limit(n)
