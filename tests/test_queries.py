import glob
import os

import pytest

from ledgerloom.plans import catalogue, general
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


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_its_sql(spark, con, name):
    assert differences(con, catalogue.QUERIES[name](spark, FOLDER), catalogue.SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_other_queries_run(spark, name):
    catalogue.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()


@pytest.fixture(scope="module")
def hollow(spark, tmp_path_factory):
    """The same tables without rows."""
    folder = tmp_path_factory.mktemp("hollow")
    for path in glob.glob(FOLDER + "/*.parquet"):
        spark.read.parquet(path).limit(0).coalesce(1).write.parquet(str(folder / os.path.basename(path)))
    return str(folder)


#: The general operators, and those others that collect something or work in rounds.
HOLLOW = [*sorted(general.QUERIES), "keyword_search", "bm25_topk", "dense_ordinals", "wide_shards", "greedy_shards", "recursive_closure", "two_hop", "topological_levels", "ir_metrics", "near_misses", "stratified_fill", "least_cost_assignment", "jsonl_round_trip", "suggestions", "bucket_traverse", "exact_search", "one_match", "citation_gate", "percentile_nearest_rank"]


@pytest.mark.parametrize("name", HOLLOW)
def test_empty_tables(spark, hollow, name):
    catalogue.QUERIES[name](spark, hollow).collect()


def test_results_do_not_depend_on_partitions(spark):
    names = ["keyword_search", "p1_profile", "p6_found", "dense_ordinals", "alias_resolution", "wide_shards"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append([sorted(map(str, catalogue.QUERIES[q](spark, FOLDER).collect())) for q in names])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]
