"""Column-level helpers: built-in Spark expressions only (JVM side, codegen)."""

from strata.functions.columns import (
    basename,
    cleaned,
    content_hash,
    join_url,
    listing_timestamp,
    rule_passes,
)
from strata.functions.names import sanitize_name

__all__ = [
    "basename",
    "cleaned",
    "content_hash",
    "join_url",
    "listing_timestamp",
    "rule_passes",
    "sanitize_name",
]
