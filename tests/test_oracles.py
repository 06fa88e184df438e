"""Every query with an SQL twin gives the twin's rows, and no plan leaves the
JVM or pairs everything with everything."""

import pytest

import __spark_entry__ as entry
from crivo.plans import oracles, queries
from tools.compare import database, differences

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
FORESTS = {"train_champion", "train_challenger", "score_proba", "score_batch", "lifecycle_run"}


@pytest.fixture(scope="module")
def connection(small):
    return database(small)


def test_only_forests_and_file_names_have_no_twin():
    assert set(queries.queries()) - set(oracles.oracle_sql()) == FORESTS | {"payload_listing"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, small, connection, name):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan
    assert differences(df.toPandas(), connection.sql(ORACLES[name]).df()) is None


def test_contract_scan_is_pruned(spark, small):
    plan = QUERIES["category_vocabulary"](spark, small)._jdf.queryExecution().executedPlan()
    scans = [line for line in plan.toString().splitlines() if "FileScan" in line]
    assert not any("o_totalprice" in s or "l_extendedprice" in s for s in scans)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(r.n for r in rows) == 1500
