"""The index of keys: what it finds, and what it reads for that."""

import glob
import re

import pytest
from helpers import final_plan
from pyspark.sql import functions as F

from tapeworks.sinks import keys
from tapeworks.sinks.keys import KeyIndex


def rows(spark, numbers):
    return spark.createDataFrame([(f"k{i}", i) for i in numbers], "trade_id string, content long")


def asked(spark, numbers):
    return rows(spark, numbers).select("trade_id")


def found(index, batch):
    return sorted(r.content for r in index.known(batch).collect())


@pytest.fixture
def index(spark, tmp_path):
    return KeyIndex(spark, str(tmp_path / "keys"), "trade_id", keys_per_part=64)


def test_every_key_is_found_and_no_other(spark, index):
    index.build(rows(spark, range(0, 1000, 2)), "t")
    assert found(index, asked(spark, range(300))) == list(range(0, 300, 2))
    assert found(index, asked(spark, range(1, 300, 2))) == []
    index.begin()
    assert not index.is_of("t")
    index.add(rows(spark, range(1, 200, 2)), 100)
    assert index.is_of("t") and not index.is_of("u")
    assert found(index, asked(spark, range(1000))) == sorted({*range(0, 1000, 2), *range(1, 200, 2)})


def test_empty_sides(spark, index):
    assert found(index, asked(spark, [1])) == []
    index.build(rows(spark, []), "t")
    assert index.is_of("t") and found(index, asked(spark, [1])) == []
    index.begin()
    index.add(rows(spark, []), 0)
    index.begin()
    index.add(rows(spark, [1]), 1)
    assert found(index, asked(spark, [])) == [] and found(index, asked(spark, [1, 2])) == [1]


def test_parts_grow_with_the_keys_and_runs_are_merged(spark, index):
    index.build(rows(spark, range(1000)), "t")
    assert [(r.parts, r.keys) for r in index.runs()] == [(16, 1000)]
    for i in range(20):
        index.begin()
        index.add(rows(spark, range(1000 + 3 * i, 1003 + 3 * i)), 3)
    assert sum(r.keys for r in index.runs()) == 1060
    assert len(index.runs()) <= 1 + 2 * keys.MERGED_RUNS
    assert len(glob.glob(f"{index.home}/keys/run=*")) == len(index.runs())
    assert found(index, asked(spark, range(990, 1100))) == list(range(990, 1060))


def test_no_task_writes_two_parts(spark):
    for parts in (1, 16, 64):
        numbered = spark.range(640).select((F.col("id") % parts).cast("int").alias("part"))
        dealt = KeyIndex._dealt(numbered, parts).select("part", F.spark_partition_id().alias("task")).distinct().collect()
        assert len(dealt) == len({r.task for r in dealt}) == parts


def test_only_parts_that_may_hold_a_key_are_read(spark, index):
    index.build(rows(spark, range(4000)), "t")
    parts = index.runs()[0].parts
    assert parts == 64
    few = index.known(asked(spark, [5, 77, 100_001, 100_002, 100_003]))
    read = {re.search(r"part=\d+", f)[0] for f in few.inputFiles() if "/keys/" in f}
    assert 1 <= len(read) <= 3
    assert index.known(asked(spark, range(100_000, 100_005))).inputFiles() == [] or len(read) < parts / 8
    plan = final_plan(few)
    assert "SortMergeJoin" not in plan and not re.search(r"\bSort \[", plan)
    new = index.candidates(asked(spark, range(200_000, 210_000))).count()
    assert new < 10_000 * 0.02


def test_a_large_batch_is_hashed_not_sorted(spark, index, monkeypatch):
    monkeypatch.setattr(keys, "BROADCAST_KEYS", 10)
    index.build(rows(spark, range(500)), "t")
    known = index.known(asked(spark, range(400)))
    assert "ShuffledHashJoin" in final_plan(known) and "SortMergeJoin" not in final_plan(known)
    assert known.agg(F.sum("content")).first()[0] == sum(range(400))
