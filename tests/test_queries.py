"""Every registered query against its SQL equivalent, on whole tables."""

import pytest

from marlstone.workload.catalog import QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    with connect(FOLDER) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, reference, name):
    query = QUERIES[name]
    assert query.sql, "every query has a SQL equivalent"
    assert differences(query.build(spark, FOLDER), reference, query.sql) is None
