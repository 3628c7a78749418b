"""Every registered query against its DuckDB oracle at sf0.01 (rows, columns, values)."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

import __spark_entry__ as contract  # noqa: E402
from check_oracles import compare  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_every_query_has_an_oracle():
    assert set(contract.core_queries()) == set(contract.core_oracles())


@pytest.mark.parametrize("name", sorted(contract.core_queries()))
def test_matches_oracle(spark, name):
    result = compare(spark, SF, [name])[name]
    assert result.startswith("ok"), result


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns == contract.entry(spark).columns
