"""JSON documents holding an array of records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.cleanse import sanitize_columns

_REC = "__strata_rec"


def explode_records(df: DataFrame, array_col: str, *, outer: bool = False, keep: Iterable[str] = ()) -> DataFrame:
    """One row per array element, struct fields as columns.

    With ``outer=False`` a missing, NULL or empty array yields no row.
    """
    keep = list(keep)
    ex = F.explode_outer(array_col) if outer else F.explode(array_col)
    return df.select(*keep, ex.alias(_REC)).select(*keep, f"{_REC}.*")


def read_json_records(
    spark: SparkSession, path: str | list[str], schema: StructType, array_col: str = "data", *, outer: bool = False
) -> DataFrame:
    """Read whole-file JSON documents, explode ``array_col``, flatten, sanitise names.

    Multi-line JSON is parsed one file per task: many documents parallelise,
    a single huge document does not.
    """
    docs = spark.read.option("multiLine", "true").option("mode", "PERMISSIVE").schema(schema).json(path)
    return sanitize_columns(explode_records(docs, array_col, outer=outer))


def unreadable_documents(spark: SparkSession, path: str | list[str], schema: StructType, array_col: str = "data") -> DataFrame:
    """``(file_path, reason)`` of whole-file JSON documents that ``read_json_records`` reads no row from.

    ``malformed``: no JSON, or values that do not fit the schema; ``no records``: a
    missing, NULL or empty array. For counting what a reader leaves out.
    """
    corrupt = "__strata_corrupt"
    full = StructType([*schema.fields, StructField(corrupt, StringType())])
    reader = spark.read.option("multiLine", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    reason = F.when(F.col(corrupt).isNotNull(), F.lit("malformed")).when(F.coalesce(F.size(array_col), F.lit(-1)) < 1, F.lit("no records"))
    docs = reader.schema(full).json(path).select(F.input_file_name().alias("file_path"), reason.alias("reason"))
    return docs.filter(F.col("reason").isNotNull())


def parse_json_records(
    df: DataFrame,
    json_col: str,
    schema: StructType,
    array_col: str = "data",
    *,
    outer: bool = False,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Same as ``read_json_records`` for documents held in a string column (row-parallel).

    The JSON parser runs once per document: it sits in a one-element
    ``explode`` (a Generate node), so the non-empty-array filter Spark infers
    for the record ``explode`` does not re-parse the document below it.
    """
    keep = list(keep)
    parsed = F.from_json(F.col(json_col), schema)
    docs = df.select(*keep, F.explode(F.array(parsed)).alias("__strata_doc"))
    flat = explode_records(docs, f"__strata_doc.{array_col}", outer=outer, keep=keep)
    return sanitize_columns(flat)
