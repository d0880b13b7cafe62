"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

from tests.oracle import compare, duck
from tidemark import catalog

NAMES = sorted(catalog.REGISTRY)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, con, name):
    q = catalog.REGISTRY[name]
    df = q.run(spark, sf_small)
    assert q.sql is not None, f"{name} has no oracle"
    problems, nrows = compare(df, con, q.sql)
    assert not problems, problems
    assert nrows > 0


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(catalog.queries()) <= set(e.oracle_sql())
