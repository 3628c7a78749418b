"""Quality rules, gates and profiles.

A rule is a SQL boolean expression (or Column) naming what a good row looks
like. A row is kept only when every rule is TRUE; NULL counts as failure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructField, StructType

from strata.functions.columns import rule_passes

Rules = Mapping[str, "str | Column"]


def _all_pass(rules: Rules) -> Column:
    checks = [rule_passes(r) for r in rules.values()]
    return reduce(lambda a, b: a & b, checks) if checks else F.lit(True)


def failed_rules(rules: Rules) -> Column:
    """Array of the names of the rules a row fails."""
    names = [F.when(~rule_passes(r), F.lit(n)) for n, r in rules.items()]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def quality_gate(df: DataFrame, rules: Rules, failed_col: str = "failed_rules") -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (kept, rejected); rejected rows carry ``failed_rules``.

    Both are lazy filters over the same plan: no extra pass unless both are
    written.
    """
    ok = _all_pass(rules)
    return df.filter(ok), df.filter(~ok).withColumn(failed_col, failed_rules(rules))


def observed_gate(df: DataFrame, rules: Rules, name: str = "quality") -> tuple[DataFrame, Observation]:
    """Kept rows plus an ``Observation`` that, once the kept rows are written,
    holds ``rows`` and ``failed_<rule>`` counts gathered in the same pass."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(~rule_passes(r)).alias(f"failed_{n}") for n, r in rules.items()]
    return df.observe(obs, *metrics).filter(_all_pass(rules)), obs


def quality_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: ``(rule, n_rows, n_failed)``, from a single scan."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(~rule_passes(r)).alias(f"f{i}") for i, r in enumerate(rules.values())]
    one = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("rule"), F.col("n_rows"), F.col(f"f{i}").alias("n_failed"))
            for i, n in enumerate(rules)
        ]
    )
    return one.select(F.inline(rows))


def duplicate_keys(
    df: DataFrame,
    keys: Sequence[str],
    count_col: str = "n",
    *,
    digest: bool = False,
) -> DataFrame:
    """Key values that occur more than once, with their count (partial counts before the shuffle).

    ``digest=True`` is for long values such as whole texts: first only a
    64-bit digest per row is counted (8 bytes cross the shuffle instead of
    the text), then only rows whose digest repeats are counted by their real
    value. A digest collision merely adds a candidate that the exact count
    then discards, so the result is exact. One plan for every size: how the
    repeated digests meet the rows is left to adaptive execution.
    """
    exact = lambda rows: (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)
    )
    if not digest:
        return exact(df)
    h = F.xxhash64(*keys).alias("__strata_h")
    repeated = (
        df.select(h).groupBy("__strata_h").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
        .select("__strata_h")
    )
    candidates = df.select(*keys, h).join(repeated, "__strata_h", "left_semi")
    return exact(candidates.drop("__strata_h"))


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "dataset") -> DataFrame:
    """Raise when ``keys`` repeat (e.g. a context table that would fan out a join)."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"{what}: keys {list(keys)} are not unique")
    return df


def missing_metadata(
    df: DataFrame, metadata: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Rows of ``df`` whose metadata is absent or has a NULL in any of ``columns``."""
    meta = metadata.select(*keys, *columns)
    joined = df.join(meta, list(keys), "left")
    return joined.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def row_profile(df: DataFrame, key: str) -> DataFrame:
    """``total_rows`` and exact ``distinct_keys`` in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("distinct_keys"))


def require_non_empty(df: DataFrame, what: str = "dataset") -> DataFrame:
    """Raise on an empty input: an empty listing must not mark every item removed."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def lacking_keys(json: Column, keys: Sequence[str]) -> Column:
    """Those of ``keys`` that a JSON object lacks (``{"k": null}`` has ``k``);
    all of them for invalid JSON or a non-object."""
    present = F.json_object_keys(json)
    flags = [F.when(~F.coalesce(F.array_contains(present, k), F.lit(False)), F.lit(k)) for k in keys]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def missing_json_keys(df: DataFrame, json_col: str, keys: Sequence[str], out_col: str = "missing_keys") -> DataFrame:
    """Rows whose JSON object lacks any of ``keys``, with the keys it lacks."""
    return df.withColumn(out_col, lacking_keys(F.col(json_col), keys)).filter(F.size(out_col) > 0)


_LIMB = 1 << 32


def fingerprint(df: DataFrame, prefix: str = "") -> DataFrame:
    """One row that stands for the multiset of ``df``'s rows: their count and sums of two 64-bit hashes of every row.

    Independent of order and partitioning, and mergeable: sums of disjoint parts
    add up. The hashes cover value, type and NULL of every column by name; each
    is summed exactly, in two halves of 32 bits.
    """
    marked = [F.struct(F.lit(c), F.lit(df.schema[c].dataType.simpleString()), F.col(f"`{c}`").isNull(), _hashable(df.schema[c], c)) for c in sorted(df.columns)]
    hashes = [F.xxhash64(F.lit(salt), *marked) for salt in (1, 2)]
    halves = [part.cast("decimal(20,0)") for h in hashes for part in (h.bitwiseAND(F.lit(_LIMB - 1)), F.shiftrightunsigned(h, 32))]
    return df.agg(F.count(F.lit(1)).alias(f"{prefix}n"), *[F.coalesce(F.sum(p), F.lit(0)).alias(f"{prefix}h{i}") for i, p in enumerate(halves)])


def _hashable(column: StructField, name: str) -> Column:
    """Nested values as text, as hashes pass NULLs inside them by; maps as their entries in order of the keys."""
    c = F.col(f"`{name}`")
    if isinstance(column.dataType, MapType):
        c = F.array_sort(F.map_entries(c))
    elif not isinstance(column.dataType, (ArrayType, StructType)):
        return c
    return F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})


def _alike(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Both frames with columns in one order and of common types; None if their columns differ."""
    cols = sorted(a.columns)
    if cols != sorted(b.columns):
        return None
    common = a.select(*cols).unionByName(b).schema
    return tuple(df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in common]) for df in (a, b))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Multiset equality of two frames with the same columns.

    Each side is read once and reduced to its ``fingerprint``; no row is shuffled.
    Two different multisets are taken for equal with a chance of about 2^-126.
    ``row_differences`` shows where sides differ.
    """
    sides = _alike(a, b)
    return sides is not None and tuple(fingerprint(sides[0]).first()) == tuple(fingerprint(sides[1]).first())


def compare_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(n_left, n_right, same)`` in one row: the comparison of ``same_rows`` as a frame."""
    left, right = (fingerprint(df).withColumn("__side", F.lit(side)) for side, df in enumerate(_alike(a, b)))
    count = lambda side: F.max(F.when(F.col("__side") == side, F.col("n")))
    prints = F.count_distinct("n", "h0", "h1", "h2", "h3")
    return left.unionByName(right).agg(count(0).alias("n_left"), count(1).alias("n_right"), (prints == 1).alias("same"))


def row_differences(a: DataFrame, b: DataFrame, side_col: str = "side") -> DataFrame:
    """Rows that one side has more often than the other, with the side: ``left`` or ``right``."""
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).withColumn(side_col, F.lit("left")).unionByName(b.exceptAll(a).withColumn(side_col, F.lit("right")))
