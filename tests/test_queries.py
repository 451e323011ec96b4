"""Every registered query against its SQL, whole tables at the smallest scale."""

import pytest

from tests.oracle import compare, duck
from tidegate.plans import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL.get(name), SF_DIR) is None


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]
    assert set(e.oracle_sql()) <= set(e.queries())
