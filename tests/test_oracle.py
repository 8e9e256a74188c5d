import pytest

import __spark_entry__ as entry
from tests.oracle_check import ROOT, compare, connect

SF_DIR = f"{ROOT}/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLE[name], SF_DIR) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["combined_text", "main_cat", "asin"]
