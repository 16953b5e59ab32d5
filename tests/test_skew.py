import random

import pytest

from pyspark.sql import functions as F
from tapeworks.functions import skew


def market(spark):
    """Half of the rows have key hot, some have none, the others are many keys; the lookup knows most of them."""
    rng = random.Random(3)
    keys = [rng.choice(["hot", "hot", None, *[f"k{i}" for i in range(30)]]) for _ in range(1000)]
    keys += ["hot"] * 900
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, n int").repartition(6)
    known = {k: keys.count(k) for k in set(keys) if k is not None and k not in ("k1", "k2")}
    lookup = spark.createDataFrame([(k, n, k.upper()) for k, n in known.items()], "key string, weight int, name string")
    return keys, known, rows, lookup


@pytest.mark.parametrize("floor", [skew.HOT_ROWS, 100, 0])
def test_lookup_is_a_left_join(spark, floor):
    keys, known, rows, lookup = market(spark)
    got = {r.n: (r.key, r.found and r.found.name) for r in skew.left_lookup(rows, lookup, ["key"], "weight", floor).collect()}
    assert got == {i: (k, k.upper() if k in known else None) for i, k in enumerate(keys)}


def test_hot_rows_are_dealt_over_the_tasks(spark):
    """Also the rows without a key."""
    _, _, rows, lookup = market(spark)
    off = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in off}
    try:
        for key, value in off.items():
            spark.conf.set(key, value)
        shares = (
            skew.left_lookup(rows, lookup, ["key"], "weight", 100)
            .withColumn("task", F.spark_partition_id())
            .filter("key is null or key = 'hot'").groupBy("task").count().collect()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    sizes = [r["count"] for r in shares]
    assert len(sizes) == 4 and max(sizes) < sum(sizes) / 2


def test_hot_keys_are_few_by_definition(spark):
    counts = spark.range(50_000).select("id", F.lit(1_500_000).alias("rows"))
    assert counts.filter(F.col("rows") > skew.hot_limit(counts, "rows")).count() == 0
    counts = counts.withColumn("rows", F.when(F.col("id") < 3, 10**12).otherwise(F.col("rows")))
    assert counts.filter(F.col("rows") > skew.hot_limit(counts, "rows")).count() == 3
