"""Name sanitising and typed cleansing of raw text columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import cleaned
from strata.functions.names import sanitize_name


def _ref(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with ``sanitize_name``; raise if two names collide."""
    new = [sanitize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both sanitise to {n!r}")
        seen[n] = old
    return df.select(*[_ref(o).alias(n) for o, n in zip(df.columns, new)])


def clean_columns(
    df: DataFrame,
    types: Mapping[str, str | None],
    *,
    rename: Mapping[str, str] | None = None,
    null_tokens: Mapping[str, Iterable[str]] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Project ``keep`` as-is, then each ``types`` column trimmed and ``try_cast``.

    ``types`` maps raw name -> Spark type (``None``/``"string"`` = trim only);
    ``rename`` maps raw -> output name; ``null_tokens`` maps raw name -> tokens
    that mean NULL after trimming (e.g. ``{"base_year": ["-"]}``).
    """
    rename = rename or {}
    null_tokens = null_tokens or {}
    cols = [_ref(k) for k in keep]
    for raw, dtype in types.items():
        cols.append(cleaned(_ref(raw), dtype, null_tokens.get(raw, ())).alias(rename.get(raw, raw)))
    return df.select(*cols)
