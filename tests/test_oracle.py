"""Every registered query against its DuckDB SQL twin at sf0.01."""

import pytest

from tidemark.plans.catalog import ORACLE, QUERIES
from tests.conftest import SF001
from tools import oracle_check


@pytest.fixture(scope="module")
def results(spark):
    return oracle_check.check(spark, SF001, verbose=False)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(results, name):
    status, detail = results[name]
    if name in ORACLE:
        assert status == "OK", detail
    else:
        assert status == "rows-only" and detail > 0


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 30
    assert set(e.oracle_sql()) <= set(e.queries())
