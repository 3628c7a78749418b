"""Fixed schemas: the ingestion log, the source inventory, raw text and JSON layouts."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Append-only ingestion log: one row per landing attempt or removal.
MANIFEST_SCHEMA = StructType(
    [
        StructField("source", StringType(), False),
        StructField("file_name", StringType(), False),
        StructField("file_path", StringType(), False),
        StructField("file_size", LongType(), True),
        StructField("source_modified_time", TimestampType(), True),
        StructField("ingestion_time", TimestampType(), False),
        StructField("status", StringType(), False),
    ]
)

# One row per item listed at the source.
INVENTORY_SCHEMA = StructType(
    [
        StructField("file_name", StringType(), True),
        StructField("source_url", StringType(), True),
        StructField("file_size", LongType(), True),
        StructField("source_modified_time", TimestampType(), True),
    ]
)

# Log status values and change actions (fixed values).
SUCCESS, FAILED, REMOVED = "SUCCESS", "FAILED", "REMOVED"
NEW, CHANGED, UNCHANGED = "NEW", "CHANGED", "UNCHANGED"
REAPPEARED = "REAPPEARED"  # opt-in: removed earlier, listed again unchanged


def _all_strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Raw tab-separated layouts (all text; typed in the cleansing layer). Fixed column lists.
OBSERVATIONS_RAW = _all_strings("series_id", "year", "period", "value", "footnote_codes")
SERIES_RAW = _all_strings(
    "series_id", "sector_code", "class_code", "measure_code", "duration_code", "seasonal",
    "base_year", "footnote_codes", "begin_year", "begin_period", "end_year", "end_period",
)
MEASURE_RAW = _all_strings("measure_code", "measure_text", "display_level", "selectable", "sort_sequence")
SECTOR_RAW = _all_strings("sector_code", "sector_name", "display_level", "selectable", "sort_sequence")
CLASS_RAW = _all_strings("class_code", "class_text", "display_level", "selectable", "sort_sequence")
DURATION_RAW = _all_strings("duration_code", "duration_text", "display_level", "selectable", "sort_sequence")
SEASONAL_RAW = _all_strings("seasonal_code", "seasonal_text")
PERIOD_RAW = _all_strings("period", "period_abbr", "period_name")
FOOTNOTE_RAW = _all_strings("footnote_code", "footnote_text")

# Yearly context JSON document: {"columns": [...], "data": [{...}, ...]}. Fixed field names.
POPULATION_RECORD = StructType(
    [
        StructField("Nation ID", StringType(), True),
        StructField("Nation", StringType(), True),
        StructField("Year", LongType(), True),
        StructField("Population", DoubleType(), True),
    ]
)
POPULATION_DOCUMENT = StructType(
    [
        StructField("columns", ArrayType(StringType()), True),
        StructField("data", ArrayType(POPULATION_RECORD), True),
    ]
)
