"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the driver contract itself."""

import os

import pytest

from presslens import catalog
from tests.conftest import SF
from tests.oracle_harness import compare, duck

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg, _ = compare(spark, name, QUERIES[name], ORACLE[name], SF, con)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "mean_score" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())
    assert os.path.isdir(e.SMOKE_DIR)
