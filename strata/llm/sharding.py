"""Sharding by a Feistel permutation with cycle walking.

Every row gets a global row number, the permutation maps that number to a
place in a reproducible shuffle, and shard and slot follow from the place by
division. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import running_number

HALF_ROUNDS = 8


def domain(n: int) -> tuple[int, int]:
    """Sides (a, b) of the smallest near-square grid with at least ``n`` cells."""
    a = max(1, math.isqrt(n))
    return a, max(1, -(-n // a))


def walks(n: int) -> int:
    """Steps that end every cycle walk.

    A walk visits each of the ``a * b - n`` surplus cells once at most, which
    bounds it; for larger grids fewer steps already leave a chance under 2**-80,
    and ``permuted`` raises instead of returning a wrong place.
    """
    a, b = domain(n)
    surplus = a * b - n
    if surplus == 0 or n == 0:
        return 1
    return min(surplus + 1, 1 + math.ceil(80 / math.log2(a * b / surplus)))


def _div(x: Column, by: int) -> Column:
    """Whole quotient of a non-negative long."""
    return F.call_function("div", x, F.lit(by).cast("long"))


def permuted(row: Column, n: int, seed: int) -> Column:
    """The place of row number ``row`` (0 to n - 1) in a shuffle of n rows.

    A number is a pair (left, right) on the grid; each half round adds a keyed
    hash of one side to the other side, which can be undone, so the map is a
    permutation of the grid. Places past n are mapped again until they fall
    inside (cycle walking).
    """
    a, b = domain(n)

    def half(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]
        moved_left = F.pmod(left + F.pmod(F.xxhash64(right, i, F.lit(seed)), F.lit(a)), F.lit(a))
        moved_right = F.pmod(right + F.pmod(F.xxhash64(left, i, F.lit(seed)), F.lit(b)), F.lit(b))
        return F.struct(
            F.when(i % 2 == 0, moved_left).otherwise(left).alias("l"),
            F.when(i % 2 == 0, right).otherwise(moved_right).alias("r"),
        )

    def once(x: Column) -> Column:
        start = F.struct(_div(x, b).alias("l"), F.pmod(x, F.lit(b)).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(HALF_ROUNDS - 1)), start, half, lambda s: s["l"] * F.lit(b) + s["r"])

    place = F.aggregate(
        F.sequence(F.lit(1), F.lit(walks(n))),
        once(row.cast("long")),
        lambda x, _: F.when(x < F.lit(n), x).otherwise(once(x)),
    )
    return F.when(place < F.lit(n), place).otherwise(F.raise_error(F.lit("cycle walk did not end"))).cast("long")


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 20261202, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row into one of ``shards`` shards; counts differ by one at most.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; null text: 1),
    text_crc32 (null text: 0), law (always ``rows``), shard, slot (gapless from
    0 in its shard), grown_shard (always null, it belongs to law ``key``).

    Row numbers run over hash buckets of id, checksum and size
    (``running_number``), so neither all rows nor those of one id are ranked in
    one task. Rows equal in all of these are interchangeable. Texts of any length
    are read whole, for their checksum. Null ids count as one more id value.
    An empty table gives no rows. Columns other than id and text are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    n = docs.count()
    numbered = running_number(rows, ["doc_id", "text_crc32", "size"], "row")
    place = permuted(F.col("row"), n, seed)
    return numbered.withColumn("place", place).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        _div(F.col("place"), shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
