import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "scripts"))


@pytest.fixture()
def docs(spark):
    """A documents table of (doc_id, text, lang, source) rows, with columns that clash with outputs."""

    def make(rows):
        wide = [(i, t, lang, source, None if t is None else len(t), 7, "x", 0.5) for i, t, lang, source in rows]
        return spark.createDataFrame(
            wide, "doc_id long, text string, lang string, source string, n_chars long, component_id long, lang_pred string, score double"
        )

    return make
