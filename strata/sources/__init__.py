"""Readers: delimited text, JSON record documents, listing pages, landed files."""

from strata.sources.delimited import parse_delimited, read_delimited
from strata.sources.json_records import explode_records, parse_json_records, read_json_records
from strata.sources.landed import read_landed
from strata.sources.listing import extract_links, parse_listing

__all__ = [
    "explode_records", "extract_links", "parse_delimited", "parse_json_records", "parse_listing",
    "read_delimited", "read_json_records", "read_landed",
]
