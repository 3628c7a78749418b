"""Expression builders used by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cleaned(c: str | Column, dtype: str | None = None, null_tokens: Iterable[str] = ()) -> Column:
    """Trim blanks (space only, like SQL ``trim``), map sentinel tokens to NULL, then ``try_cast``.

    ``try_cast`` keeps malformed cells as NULL under ANSI mode so a quality
    rule can drop and count them instead of the cast failing the whole job.
    """
    out = F.trim(_col(c))
    for token in null_tokens:
        out = F.nullif(out, F.lit(token))
    if dtype is not None and dtype != "string":
        out = out.try_cast(dtype)
    return out


def rule_passes(rule: str | Column) -> Column:
    """TRUE only when the rule is TRUE; a NULL rule result counts as a failure."""
    expr = F.expr(rule) if isinstance(rule, str) else rule
    return F.coalesce(expr, F.lit(False))


def listing_timestamp(text: str | Column, fmt: str = "M/d/yyyy h:mm a") -> Column:
    """Parse a listing time such as ``8/6/2026  8:30 AM``.

    Blank runs are collapsed first (the listing pads with two blanks);
    ``try_to_timestamp`` gives NULL for impossible dates instead of failing.
    """
    return F.try_to_timestamp(F.regexp_replace(_col(text), r"\s+", " "), F.lit(fmt))


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved; one that ends in such a segment keeps a final ``/``."""
    parts = F.split(path, "/")
    up = lambda done: F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
    walked = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", up(done)).when(part == ".", done).otherwise(F.array_append(done, part)),
    )
    ends = F.element_at(parts, -1).isin(".", "..")
    joined = F.concat(F.array_join(walked, "/"), F.when(ends, F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.regexp_replace(joined, "^(?!/)", "/")).otherwise(path)


def join_url(base: str | Column, href: str | Column) -> Column:
    """Resolve a link against an absolute hierarchical base URL.

    A link with a scheme (``https:``, ``mailto:``) is kept; ``//host/x`` takes
    the base's scheme, ``/x`` its host, ``?q`` its path, ``#f`` all of it
    but the fragment, an empty link all of it, and anything else its directory. ``.`` and
    ``..`` segments are resolved and never climb above the host; empty segments
    of a relative link collapse.
    """
    base_c = F.lit(base) if isinstance(base, str) else base
    href_c = _col(href)
    parts = r"^([a-zA-Z][a-zA-Z0-9+.-]*:)(//[^/?#]*)([^?#]*)(\?[^#]*)?"
    scheme, host, path, query = (F.regexp_extract(base_c, parts, i) for i in (1, 2, 3, 4))
    origin = F.concat(scheme, host)
    own = F.regexp_extract(href_c, r"^[^?#]*", 0)
    tail = F.regexp_extract(href_c, r"^[^?#]*(.*)$", 1)
    directory = F.concat(F.regexp_replace(path, r"[^/]*$", ""))
    relative = F.regexp_replace(F.concat(F.when(directory == "", F.lit("/")).otherwise(directory), own), r"/{2,}", "/")
    return (
        F.when(href_c == "", base_c)
        .when(href_c.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href_c)
        .when(href_c.startswith("//"), F.concat(scheme, href_c))
        .when(href_c.startswith("/"), F.concat(origin, _without_dots(own), tail))
        .when(own != "", F.concat(origin, _without_dots(relative), tail))
        .when(tail.startswith("?"), F.concat(origin, path, tail))
        .otherwise(F.concat(origin, path, query, tail))
    )


def basename(path: str | Column) -> Column:
    """Last path segment, ignoring a trailing ``/`` (``/pub/a/`` -> ``a``)."""
    return F.element_at(F.split(F.regexp_replace(_col(path), r"/+$", ""), "/"), -1)


def content_hash(c: str | Column) -> Column:
    """SHA-256 hex of the content (text or binary); equal hashes stand for equal bytes."""
    return F.sha2(_col(c), 256)
