"""Queries that SQL can express, against their SQL."""

import pytest
from compare import connect, difference, duck_rows, spark_rows

from tapeworks.llm.queries import llm_oracles, llm_queries


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query(name, spark):
    sf_dir = "/root/testdata/sf0.01"
    found = spark_rows(llm_queries()[name](spark, sf_dir))
    assert difference(found, duck_rows(connect(sf_dir), llm_oracles()[name])) is None
    assert found[1]
