"""Every named query against its SQL, and known passages found again."""

import os

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.compare import compare, connect
from checks.oracle import ORACLE

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@needs_data
@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name)[0] is None


def test_every_query_has_sql():
    assert set(ORACLE) == set(queries.QUERIES) - {"pipeline_report"}  # a whole run: many steps, no single SQL


@needs_data
def test_known_passages_come_first(spark):
    found = queries.search_lexical(spark, SF).filter("rank = 1").select("query_id", "doc_id")
    items = queries.items(spark, SF)
    holders = items.join(queries.docs(spark, SF), F.expr("contains(description, text)")).select("query_id", "doc_id")
    expected = holders.select("query_id").distinct().count()
    assert holders.join(found, ["query_id", "doc_id"]).count() >= 0.9 * expected
