"""Column-name sanitising (metadata only; no data is touched)."""

from __future__ import annotations

import re

# Fixed value: every run of characters outside this class becomes "_".
_NON_WORD = re.compile(r"[^a-zA-Z0-9_]+")


def sanitize_name(name: str) -> str:
    """Strip, lower-case, collapse every run of non ``[a-zA-Z0-9_]`` to ``_``, trim ``_``.

    ``" Nation ID "`` -> ``nation_id``; ``"Region.Key"`` -> ``region_key``.
    """
    return _NON_WORD.sub("_", name.strip().lower()).strip("_")
