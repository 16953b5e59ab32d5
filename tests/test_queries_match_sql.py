"""Every registered query against its SQL, bit for bit."""

import pytest
from compare import connect, difference, duck_rows, spark_rows
from helpers import final_plan

import __spark_entry__ as entry_points
from tapeworks.plans.catalog import all_queries
from tapeworks.plans.oracles import all_oracles


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


# Nodes that would not survive large tables: all pairs, one task for everything, rows handed to Python.
UNSCALABLE = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas",
              "FlatMapGroupsInPandas", "windowspecdefinition(source_ts", "RowDataSourceScan"]


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(name, spark, sf_dir, duck):
    df = entry_points.queries()[name](spark, sf_dir)
    plan = final_plan(df)
    assert not [node for node in UNSCALABLE if node in plan]
    found = spark_rows(df)
    wanted = duck_rows(duck, entry_points.oracle_sql()[name])
    assert difference(found, wanted) is None
    assert found[1], "an empty result proves nothing"


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
