"""DataFrame -> DataFrame operators (built-in Spark expressions only).

``enrich`` and ``preview`` are imported from their modules
(``strata.operators.enrich``, ``strata.operators.preview``); re-exporting
them here would shadow those modules.
"""

from strata.operators.analytics import best_period, range_stats, series_with_context
from strata.operators.changes import action_counts, classify_changes, classify_content, detect_removed
from strata.operators.cleanse import clean_columns, sanitize_columns
from strata.operators.enrich import DimSpec, describe
from strata.operators.latest import latest_by_key
from strata.operators.quality import (
    assert_unique,
    duplicate_keys,
    failed_rules,
    missing_json_keys,
    missing_metadata,
    observed_gate,
    quality_gate,
    quality_report,
    require_non_empty,
    row_profile,
    same_rows,
)
from strata.operators.ranking import top_with_ties

__all__ = [
    "DimSpec", "action_counts", "assert_unique", "best_period", "classify_changes", "classify_content",
    "clean_columns", "describe", "detect_removed", "duplicate_keys", "failed_rules",
    "latest_by_key", "missing_json_keys", "missing_metadata", "observed_gate", "quality_gate",
    "quality_report", "range_stats", "require_non_empty", "row_profile", "same_rows", "sanitize_columns",
    "series_with_context", "top_with_ties",
]
