"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from regfuse.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(catalog.QUERIES) - set(E.oracle_sql())
    assert rows_only == {"file_inventory"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"match_method", "source", "rows"}
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, con)
    if r.get("oracle") == "none":
        assert r["spark_rows"] >= 0
        return
    assert r["cols_equal"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_equal"], r
