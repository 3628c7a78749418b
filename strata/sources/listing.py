"""Link and inventory extraction from tables of HTML / directory-listing pages.

Each page is one row; extraction is per row (``regexp_extract_all`` +
``explode``), so pages spread over tasks and no page passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import basename, join_url, listing_timestamp

# An <a> tag with its attributes: quoted values are taken whole, so a ">" in one
# does not end the tag. Then one attribute: its name, and its value if it has one
# (double-quoted, single-quoted or bare).
ANCHOR = r"""(?i)<a(?=[\s/])((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>"""
ATTRIBUTE = r"""[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?"""
# Not markup: comments and the content of raw-text elements (script, style);
# links inside them do not count. One pass over the page; the shared "<" is
# factored out so the engine tries the alternatives only at a "<".
HTML_NOT_MARKUP = r"(?is)<(?:!--.*?-->|script\b[^>]*>.*?</script\s*>|style\b[^>]*>.*?</style\s*>)"
# Named character references decoded in attribute values (fixed values; "&amp;" last).
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))


def _numbered(value: Column) -> Column:
    """Numeric character references, decimal and hexadecimal, as the letters they stand for."""
    refs = F.array_distinct(F.regexp_extract_all(value, F.lit(r"(?i)&#(?:x[0-9a-f]{1,6}|[0-9]{1,7});"), 0))

    def letter(ref: Column) -> Column:
        hexed = F.regexp_extract(ref, "(?i)x([0-9a-f]+)", 1)
        code = F.when(hexed != "", hexed).otherwise(F.conv(F.regexp_extract(ref, "([0-9]+)", 1), 10, 16))
        known = F.conv(code, 16, 10).cast("long").between(1, 0x10FFFF) & ~F.conv(code, 16, 10).cast("long").between(0xD800, 0xDFFF)
        return F.when(known, F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))

    decoded = F.aggregate(refs, value, lambda text, ref: F.replace(text, ref, letter(ref)))
    return F.when(F.contains(value, F.lit("&#")), decoded).otherwise(value)


def attribute_value(raw: Column) -> Column:
    """Strip the quotes around an attribute value and decode its character references."""
    value = _numbered(F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1$""", "$2"))
    for entity, char in ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(char))
    return value


def extract_links(
    df: DataFrame, html_col: str, prefix: str = "", *, keep: Iterable[str] = (), name_col: str = "file_name"
) -> DataFrame:
    """One row per link whose last path segment starts with ``prefix`` (case-sensitive).

    A link is the value of an attribute named ``href`` (not ``data-href``) of an
    ``<a>`` tag; the first one counts where a tag repeats it. Order within a
    page and duplicates are kept. Output: ``keep`` + ``href`` + ``name_col``.
    """
    keep = list(keep)
    text = F.regexp_replace(F.col(html_col), HTML_NOT_MARKUP, "")
    tags = df.select(*keep, F.explode(F.regexp_extract_all(text, F.lit(ANCHOR), 1)).alias("__tag"))
    # decoded inside the generator: once per link, whatever reads it afterwards
    found = tags.select(*keep, F.explode(first_href(F.col("__tag"))).alias("href"))
    links = found.withColumn(name_col, basename("href"))
    return links.filter(F.col(name_col).startswith(prefix)) if prefix else links


def first_href(attributes: Column) -> Column:
    """Array of the decoded value of the first ``href`` attribute of a tag; empty where it has none."""
    own = F.filter(F.regexp_extract_all(attributes, F.lit(ATTRIBUTE), 0), lambda a: a.rlike(r"(?i)^href\s*="))
    return F.transform(F.slice(own, 1, 1), lambda a: attribute_value(F.regexp_replace(a, r"(?i)^href\s*=\s*", "")))


def parse_listing(
    df: DataFrame,
    html_col: str,
    base_url: str | Column,
    prefix: str = "pr.",
    *,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Inventory rows ``(file_name, source_url, file_size, source_modified_time)`` from
    directory-listing text.

    An entry is a link whose label starts with ``prefix`` (any case) and whose
    text since the tag before it ends in a date, a time, AM or PM, and a size.
    Its other attributes, their order and the kind of quotes do not matter.
    Impossible dates and sizes beyond a long give NULL, not an error.
    """
    keep = list(keep)
    # the text between two tags, the link's tag, its label; a run of text is entered at its start only
    linked = r"(?<![^<>])([^<>]*+)" + ANCHOR.removeprefix("(?i)") + r"([^<]*+)"
    linked = "(?i)" + linked
    group = lambda e, i: F.regexp_extract(e, linked, i)
    named = F.filter(
        F.regexp_extract_all(F.col(html_col), F.lit(linked), 0), lambda e: F.lower(group(e, 3)).startswith(prefix.lower())
    )
    found = df.select(*keep, F.explode(named).alias("__entry"))
    words = F.split(F.trim(F.regexp_replace(group(F.col("__entry"), 1), r"\s+", " ")), " ")
    parts = found.select(
        *keep, group(F.col("__entry"), 3).alias("file_name"), words.alias("__w"), F.explode(first_href(group(F.col("__entry"), 2))).alias("__href")
    ).filter(F.size("__w") >= 4)
    word = lambda i: F.element_at("__w", -i)
    dated = word(4).rlike(r"\d{1,2}/\d{1,2}/\d{4}$") & word(3).rlike(r"^\d{1,2}:\d{2}$") & F.upper(word(2)).isin("AM", "PM")
    return parts.filter(dated & word(1).rlike(r"^\d+$")).select(
        *keep,
        "file_name",
        join_url(base_url, "__href").alias("source_url"),
        word(1).try_cast("bigint").alias("file_size"),
        listing_timestamp(F.concat_ws(" ", F.regexp_extract(word(4), r"[\d/]+$", 0), word(3), word(2))).alias("source_modified_time"),
    )
