"""Star / snowflake enrichment by chained left joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

@dataclass
class DimSpec:
    """One dimension of a star join.

    ``fact_key`` names a column already on the left side (from the fact or a
    dimension joined earlier); ``dim_key`` is the matching dimension column;
    ``columns`` are carried over, optionally renamed via ``rename``.
    """

    df: DataFrame
    fact_key: str
    dim_key: str
    columns: Sequence[str]
    rename: dict[str, str] = field(default_factory=dict)


def enrich(fact: DataFrame, dims: Sequence[DimSpec]) -> DataFrame:
    """Left-join each dimension in order; fact rows are never dropped or multiplied
    unless a dimension key repeats (see ``quality.assert_unique``).

    Each dimension is narrowed to its key + wanted columns before the join, so
    only those columns are read and shuffled. No side carries a broadcast hint
    and no job runs while the plan is built: whether a side is broadcast is
    left to the size that adaptive execution measures
    (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
    """
    out = fact
    for i, d in enumerate(dims):
        key = f"__strata_dim{i}_key"
        cols = [F.col(c).alias(d.rename.get(c, c)) for c in d.columns]
        side = d.df.select(F.col(d.dim_key).alias(key), *cols)
        out = out.join(side, out[d.fact_key] == side[key], "left").drop(key)
    return out


def describe(parts: Sequence[str | Column], sep: str = " | ") -> Column:
    """Readable label from parts; NULL parts are skipped, never nulling the label."""
    return F.concat_ws(sep, *[F.col(p) if isinstance(p, str) else p for p in parts])
