"""Mixing sources to target weights by Pfair scheduling.

Source s with weight u out of W slots owes its j-th block (from 1) inside the
window from slot floor((j-1)W/u), its release, to slot ceil(jW/u), its
deadline. Among released blocks the earliest deadline goes first. All weights
sum to W, so the schedule repeats after W slots and every source is always
less than one block away from its share. One period is worked out from the
weights alone; the rows are placed with DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import running_number

REST = "*"
MAX_SLOTS = 10_000


def pfair_period(units: dict[str, int]) -> dict[str, list[tuple[int, int, int]]]:
    """Per source its blocks of one period: (slot, release, deadline).

    Ties between deadlines go to the source named first. The number of slots,
    the sum of the weights, is a parameter of at most ``MAX_SLOTS``.
    """
    if not units or any(int(u) != u or u < 1 for u in units.values()):
        raise ValueError("weights must be whole numbers of at least 1")
    total = sum(units.values())
    if total > MAX_SLOTS:
        raise ValueError(f"weights sum to more than {MAX_SLOTS} slots")
    period: dict[str, list[tuple[int, int, int]]] = {s: [] for s in units}
    for t in range(total):
        ready = []
        for place, (s, u) in enumerate(units.items()):
            j = len(period[s]) + 1
            if j <= u and (j - 1) * total // u <= t:
                ready.append((-(-j * total // u), place, s, (j - 1) * total // u))
        deadline, _, s, release = min(ready)
        period[s].append((t, release, deadline))
    return period


def _quotient(x: Column, by: Column) -> Column:
    return F.call_function("div", x, by)


#: Column names that ``mix_sources`` uses for itself.
TAKEN = frozenset(
    "mix_class mix_size mix_block mix_release mix_deadline mix_slot mix_start __mix_check __mix_unit __mix_id "
    "__bucket __group __sum __base __in __offset __local".split()
)


def taken(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c.lower() in TAKEN]


def mix_sources(
    docs: DataFrame, weights: dict[str, int], block_bytes: int = 16_384, id_col: str = "doc_id",
    source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """Give every row its place in a stream that follows the target weights.

    ``weights`` maps a source to whole weight units; ``"*"`` stands for all
    sources it does not name, null included (weight 1 if not given). A source's
    rows, in the order of hash buckets of their id, size and checksum, form one stream of bytes
    (UTF-8 text plus 1), cut into blocks of ``block_bytes``; a row belongs to
    the block in which it starts. At every slot boundary each source that still
    has rows is less than one block away from its share (plus the row that
    crosses the boundary). When a source ends its slots stay empty; no row is
    dropped or repeated.

    Adds mix_class, mix_size, mix_block, mix_release, mix_deadline, mix_slot and
    mix_start (its first byte in its source's stream) to the given columns.
    Equal ids are ranked by their size and checksum. Empty tables give no rows;
    null texts have size 1; a text of any length is one row of its whole size. The
    columns added replace ones of the same name, in any case; columns named like
    the helpers in ``TAKEN`` do not come along; all others do.
    """
    rows = docs.drop(*taken(docs))
    return scheduled(rows.withColumns(mix_columns(weights, id_col, source_col, text_col)), weights, block_bytes)


def mix_columns(weights: dict[str, int], id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> dict[str, Column]:
    """All that a row's place in the mixture depends on: its class, size, checksum and id."""
    named = [s for s in weights if s != REST]
    return {
        "mix_class": F.when(F.col(source_col).isin(named), F.col(source_col)).otherwise(F.lit(REST)) if named else F.lit(REST),
        "mix_size": (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long"),
        "__mix_check": F.xxhash64(F.col(text_col)),
        "__mix_id": F.col(id_col),
    }


def scheduled(rows: DataFrame, weights: dict[str, int], block_bytes: int = 16_384) -> DataFrame:
    """``mix_sources`` of rows that have their ``mix_columns``; the text is not needed."""
    units = dict(weights)
    units.setdefault(REST, 1)
    total = sum(units.values())
    period = pfair_period(units)
    rows = running_number(
        rows, ["__mix_id", "mix_size", "__mix_check"], "mix_start", within=["mix_class"], weight="mix_size"
    )
    table = lambda i: F.create_map(*[x for s, blocks in period.items() for x in (F.lit(s), F.array(*[F.lit(b[i]) for b in blocks]))])
    unit = F.create_map(*[x for s, u in units.items() for x in (F.lit(s), F.lit(u).cast("long"))])
    rows = rows.withColumns({
        "mix_block": _quotient(F.col("mix_start"), F.lit(block_bytes).cast("long")),
        "__mix_unit": F.element_at(unit, F.col("mix_class")),
    })
    turn = (F.pmod("mix_block", "__mix_unit") + 1).cast("int")
    at = _quotient(F.col("mix_block"), F.col("__mix_unit")) * F.lit(total).cast("long")
    own = lambda i: at + F.element_at(F.element_at(table(i), F.col("mix_class")), turn)
    return rows.withColumns({"mix_slot": own(0), "mix_release": own(1), "mix_deadline": own(2)}).drop("__mix_check", "__mix_unit", "__mix_id")


def stream_positions(mixed: DataFrame, weights: dict[str, int], block_bytes: int = 16_384) -> DataFrame:
    """Add ``mix_position``: gapless from 0 by slot, then by place in the block.

    Periods of the schedule are counted first and their offsets summed in two
    levels; rows are ranked inside their period only.
    """
    total = sum(weights.values()) + (REST not in weights)
    many = F.lit(4096).cast("long")
    rows = mixed.withColumn("__period", _quotient(F.col("mix_slot"), F.lit(total).cast("long")))
    counts = rows.groupBy("__period").agg(F.count(F.lit(1)).alias("__n")).withColumn("__super", _quotient(F.col("__period"), many))
    supers = counts.groupBy("__super").agg(F.sum("__n").alias("__n")).select(
        "__super", F.coalesce(F.sum("__n").over(W.orderBy("__super").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__base")
    )
    ahead = W.partitionBy("__super").orderBy("__period").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("__inner", F.coalesce(F.sum("__n").over(ahead), F.lit(0))).join(supers, "__super").select(
        "__period", (F.col("__base") + F.col("__inner")).alias("__offset")
    )
    rank = F.row_number().over(W.partitionBy("__period").orderBy("mix_slot", "mix_start")) - 1
    placed = rows.withColumn("__rank", rank).join(offsets, "__period")
    return placed.withColumn("mix_position", F.col("__offset") + F.col("__rank")).drop("__period", "__rank", "__offset")
