"""Every registered query against its reference SQL, and the shape of every plan."""

import re

import pytest

from __spark_entry__ import entry
from checks import registry
from checks.compare import connect, difference

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_reference_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["date", "plant"]
    assert df.count() > 0


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, old)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("report_transit") or n == "report_transit_cleared"])
def test_no_forced_broadcast_nested_loop_or_python(no_broadcast, sf_dir, name):
    plan = QUERIES[name](no_broadcast, sf_dir)._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"BroadcastNestedLoopJoin|CartesianProduct|BroadcastHashJoin|EvalPython|MapInPandas|Scan ExistingRDD", plan)
    assert not found
