from collections import Counter

from helpers import bronze, final_plan, payload

from pyspark.sql import functions as F
from tapeworks.operators import silver


def test_newest_record_wins(spark):
    df = bronze(
        spark,
        (payload(price=1.0), "2024-05-01 10:00:00"),
        (payload(price=2.0), "2024-05-01 11:00:00"),
        (payload(price=3.0), "2024-05-01 11:00:00"),
        (payload(price=4.0), None),
        (payload(trade_id="b"), None),
    )
    got = {r.trade_id: r.price for r in silver.to_silver(df).collect()}
    assert got == {"a": 3.0, "b": 10.5}


def test_bad_record_does_not_displace_a_good_one(spark):
    df = bronze(spark, (payload(price=1.0), "2024-05-01 10:00:00"), (payload(side="HOLD"), "2024-05-02 10:00:00"))
    assert [r.price for r in silver.to_silver(df).collect()] == [1.0]


def test_every_record_is_silver_or_rejected(spark):
    values = [
        payload(), (payload(price=2.0), "2024-05-02 00:00:00"), "{oops", "", None, payload(symbol=None),
        payload(trade_id=None), payload(trade_id=None), payload(trade_id="c", side="x"), payload(trade_id="d"),
    ]
    df = bronze(spark, *values)
    kept, lost = silver.to_silver(df).collect(), silver.rejects(df).collect()
    assert len(kept) + len(lost) == len(values)
    assert Counter(r for row in lost for r in row.reasons) == {
        "unparsable": 3, "missing_symbol": 1, "missing_trade_id": 2, "invalid_side": 1, "duplicate_trade_id": 1}
    assert next(r for r in lost if r.reasons == ["duplicate_trade_id"]).price == 10.5


def test_hot_trade_is_reduced_before_the_shuffle(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("trade_id"),
        F.lit("S").alias("symbol"), F.lit(1.0).alias("price"), F.col("id").cast("double").alias("quantity"),
        F.lit("buy").alias("side"), F.lit(None).cast("timestamp").alias("source_ts"),
        F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"),
    )
    df = silver.keep_newest(rows)
    got = df.collect()
    assert len(got) == 2001
    assert next(r.quantity for r in got if r.trade_id == "hot") == 2997.0
    above, below = final_plan(df).split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_hot_rejects(spark):
    """A third of the records share one id, another third has none."""
    raw = spark.range(900).select(
        F.lit("k").alias("kafka_key"),
        F.when(F.col("id") % 3 == 0, F.lit(payload(trade_id="hot")))
        .when(F.col("id") % 3 == 1, F.lit(payload(trade_id=None)))
        .otherwise(F.concat(F.lit(payload(trade_id=...)[:-1] + ', "trade_id": "t'), "id", F.lit('"}'))).alias("raw_value"),
        F.lit("t").alias("kafka_topic"), F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"),
        F.lit("2024-05-01").cast("timestamp").alias("source_ts"),
        F.lit("2024-05-01").cast("timestamp").alias("ingestion_time"),
    )
    for hot_rows in (silver.HOT_ROWS, 10):
        got = Counter(r.reasons[0] for r in silver.rejects(raw, hot_rows=hot_rows).collect())
        assert got == {"duplicate_trade_id": 299, "missing_trade_id": 300}
    assert silver.to_silver(raw).count() == 301


def test_what_silver_knows_of_a_batch(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "trade_id string, n int")
    keys = spark.createDataFrame([("b", 7), ("x", 8)], "trade_id string, content long")
    found = {r.trade_id: r.known for r in silver.against_known(batch, keys).collect()}
    assert found == {"a": None, "b": 7, "c": None}
    assert silver.against_known(batch, keys.filter("false")).filter("known is null").count() == 3
