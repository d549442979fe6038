"""Every registered query against its DuckDB oracle at sf0.01 (the correctness gate)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF01
from tests.oracle_compare import compare
from tidepool.plans.registry import ORACLE, QUERIES, load_all

load_all()          # queries of optional subpackages have their own tests


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF01), con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["skill", "vacancies_count"]
