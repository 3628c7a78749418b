"""Delimited text with a fixed schema."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


#: A line of more fields than its schema is no good row (readers with ``extra_col="extra_fields"``).
NO_EXTRA_FIELDS = {"no_extra_fields": "extra_fields IS NULL"}


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = "\t",
    header: bool = True,
    *,
    quoting: bool = True,
    extra_col: str | None = None,
) -> DataFrame:
    """Read delimited text with an explicit schema (no inference pass).

    Columns bind by position; a header line is skipped, whatever its text.
    Short rows get trailing NULLs, extra fields are dropped, an empty cell is
    NULL, blanks inside cells are kept (trim in the cleansing layer). Files
    split across tasks by ``spark.sql.files.maxPartitionBytes``.
    ``quoting=False`` treats quote characters as text (plain TSV).

    With ``extra_col`` the first field beyond the schema is kept in a column of
    that name (NULL where there is none or it is empty), so that a quality rule
    like ``NO_EXTRA_FIELDS`` counts and drops lines of too many fields.
    """
    if extra_col:
        schema = StructType([*schema.fields, StructField(extra_col, StringType())])
    reader = spark.read.option("header", str(header).lower()).option("sep", sep).option("mode", "PERMISSIVE")
    if not quoting:  # plain TSV: a quote character is ordinary text
        reader = reader.option("quote", "")
    return reader.schema(schema).csv(path)


def parse_delimited(
    df: DataFrame,
    line_col: str,
    schema: StructType,
    sep: str = "\t",
    keep: Iterable[str] = (),
    *,
    quoting: bool = True,
    extra_col: str | None = None,
) -> DataFrame:
    """Parse a column of delimited lines with the same rules as ``read_delimited``, ``extra_col`` included.

    The parser runs once per line: it sits in a one-element ``explode``, a
    Generate node that later filters cannot be pushed below. Otherwise
    predicate pushdown would substitute ``from_csv(line)`` into every filter
    and projection that reads a field, parsing each line several times.

    ``quoting=False`` is for text known to hold no quote characters (plain
    TSV): fields are split on ``sep`` instead of run through the CSV parser,
    with the same binding (by position, empty -> NULL, short rows padded with
    NULL, extra fields dropped), at a fraction of the cost.
    """
    keep = list(keep)
    if extra_col:
        schema = StructType([*schema.fields, StructField(extra_col, StringType())])
    if quoting:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parsed = F.from_csv(F.col(line_col), F.lit(ddl), {"sep": sep, "mode": "PERMISSIVE"})
        return df.select(*keep, F.explode(F.array(parsed)).alias("__strata_rec")).select(*keep, "__strata_rec.*")
    # split once per line (inside the Generate), then read the fields from the array
    parts = F.split(F.col(line_col), re.escape(sep), -1)
    split = df.select(*keep, F.explode(F.array(parts)).alias("__strata_parts"))
    fields = []
    for i, f in enumerate(schema.fields):
        cell = F.nullif(F.get(F.col("__strata_parts"), i), F.lit(""))
        fields.append((cell if f.dataType == StringType() else cell.try_cast(f.dataType)).alias(f.name))
    return split.select(*keep, *fields)
