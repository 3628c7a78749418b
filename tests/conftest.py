import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from strata.schemas import INVENTORY_SCHEMA, MANIFEST_SCHEMA  # noqa: E402
from strata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="strata-tests")
    yield s
    s.stop()


@pytest.fixture()
def log_rows(spark):
    """Build a manifest-log DataFrame from tuples."""

    def make(rows):
        return spark.createDataFrame(rows, MANIFEST_SCHEMA)

    return make


@pytest.fixture()
def inventory(spark):
    def make(rows):
        return spark.createDataFrame(rows, INVENTORY_SCHEMA)

    return make


T1 = datetime(2026, 8, 1, 9, 0)
T6 = datetime(2026, 8, 6, 8, 30)
RUN1 = datetime(2026, 8, 2, 0, 0)
RUN2 = datetime(2026, 8, 7, 0, 0)
