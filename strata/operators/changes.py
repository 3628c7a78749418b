"""Change detection between a current snapshot and the previous state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import content_hash
from strata.schemas import CHANGED, NEW, SUCCESS, UNCHANGED

_SEEN = "__strata_seen"


def classify_changes(
    current: DataFrame,
    previous: DataFrame,
    keys: Sequence[str],
    track: Sequence[str],
    *,
    null_safe: bool = False,
    prev_prefix: str = "prev_",
    action_col: str = "action",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Label every current row NEW / CHANGED / UNCHANGED against ``previous``.

    NEW: no previous row with the same keys. CHANGED: any tracked column
    differs. With ``null_safe=False`` the test is SQL three-valued
    (``a <> b OR c <> d``): a NULL on either side yields UNCHANGED unless
    another tracked column differs for certain. ``null_safe=True`` treats
    NULL vs value as a change.

    ``previous`` must hold one row per key (see ``latest_by_key``). Output:
    current columns + ``prev_<track>`` + ``action``, and ``prev_<carry>`` for
    previous columns that are carried along without being compared. One left
    join on the keys.
    """
    prev = previous.select(
        *[F.col(k) for k in keys],
        *[F.col(c).alias(prev_prefix + c) for c in [*track, *carry]],
        F.lit(True).alias(_SEEN),
    )
    joined = current.join(prev, list(keys), "left")
    if null_safe:
        diffs = [~F.col(c).eqNullSafe(F.col(prev_prefix + c)) for c in track]
    else:
        diffs = [F.col(c) != F.col(prev_prefix + c) for c in track]
    changed = reduce(lambda a, b: a | b, diffs) if diffs else F.lit(False)
    action = F.when(F.col(_SEEN).isNull(), F.lit(NEW)).when(changed, F.lit(CHANGED)).otherwise(F.lit(UNCHANGED))
    return joined.withColumn(action_col, action).drop(_SEEN)


def detect_removed(
    state: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    *,
    status_col: str = "status",
    active: str = SUCCESS,
) -> DataFrame:
    """Keys whose latest state is ``active`` but which are absent from ``current``.

    A key whose latest state is REMOVED or FAILED is never reported again.
    Left anti join; only the key columns of ``current`` are read.
    """
    live = state.filter(F.col(status_col) == active)
    return live.join(current.select(*keys), list(keys), "left_anti")


def classify_content(
    current: DataFrame,
    previous: DataFrame,
    keys: Sequence[str],
    content_col: str,
    *,
    previous_content_col: str | None = None,
    previous_hash_col: str | None = None,
    hash_col: str = "content_sha256",
    action_col: str = "action",
) -> DataFrame:
    """NEW / CHANGED / UNCHANGED by content equality.

    Both sides are reduced to a SHA-256 before the join and the content column
    is dropped there, so only 64-character digests cross the shuffle, never the
    whole contents. ``previous_hash_col`` names a digest that ``previous``
    already holds (``read_landed(..., with_hash=True)``); its bytes are then
    not read at all.
    """
    known = F.col(previous_hash_col) if previous_hash_col else content_hash(previous_content_col or content_col)
    cur = current.withColumn(hash_col, content_hash(content_col)).drop(content_col)
    return classify_changes(cur, previous.select(*keys, known.alias(hash_col)), keys, [hash_col], action_col=action_col)


def action_counts(classified: DataFrame, action_col: str = "action") -> DataFrame:
    """Histogram of actions: ``(action, n)``."""
    return classified.groupBy(action_col).agg(F.count(F.lit(1)).alias("n"))
