import os

import pytest

from ledgerloom.llm import queries
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't here")


@pytest.fixture(autouse=True, scope="module")
def generated_code(spark):
    """These tests run the code that jobs run; the others interpret plans, which is quicker for small tables."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(connect(FOLDER), queries.QUERIES[name](spark, FOLDER), queries.SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_other_queries_run(spark, name):
    queries.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
