"""Every query with a DuckDB twin matches it exactly (after the shared
6-decimal rounding) on the smallest scale factor."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.helpers import assert_same, duck

# the subpackage's own queries are tested in tests/llm
_LLM = entry._llm()
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k not in _LLM[0]}
QUERIES = {k: v for k, v in entry.queries().items() if k not in _LLM[0]}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLE[name]).df()
    spark.catalog.clearCache()
    assert_same(got, want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).toPandas()
    assert len(rows) > 0
    numbers = rows.select_dtypes("number")
    assert numbers.notna().any().all(), "a numeric column holds nothing"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "macd_signal" in df.columns
