"""Newest price of every symbol, kept by a streaming aggregate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks.operators.marts import TOLERANCE, latest_price
from tapeworks.sinks.files import write_batch
from tapeworks.streaming.runs import in_tiers, start_batches

COLUMNS = ["symbol", "price", "trade_ts", "trade_id", "source_ts"]


def start_latest_price(
    trades: DataFrame, path: str, checkpoint: str, tolerance: str = TOLERANCE, trigger: dict | None = None
) -> StreamingQuery:
    """Every micro-batch adds the symbols it has changed; read them with :func:`read_latest`.

    Spark's state holds one row per symbol: the newest trade in time and the broker's newest time. The aggregate
    combines before its shuffle, so a hot symbol is one row of each task. Trades ahead of the broker's clock move
    neither.
    """
    place = F.struct("trade_ts", "trade_id", "price")
    sane = F.col("trade_ts") <= F.col("source_ts") + F.expr(f"interval {tolerance}")
    newest = trades.groupBy("symbol").agg(
        F.max(F.when(sane & F.col("price").isNotNull(), place)).alias("last"), F.max("source_ts").alias("source_ts")
    ).select("symbol", "last.price", "last.trade_ts", "last.trade_id", "source_ts")
    step = in_tiers(lambda batch, batch_id: write_batch(batch, path, batch_id), path, merge=newest_of)
    return start_batches(newest, step, checkpoint, trigger, mode="update")


def newest_of(seen: DataFrame) -> DataFrame:
    """One row per symbol: its newest trade of all that batches have written, and the broker's newest time."""
    last = F.max(F.when(F.col("price").isNotNull(), F.struct("trade_ts", "trade_id", "price"))).alias("last")
    return seen.groupBy("symbol").agg(last, F.max("source_ts").alias("source_ts")).select(
        "symbol", "last.price", "last.trade_ts", "last.trade_id", "source_ts")


def read_latest(spark: SparkSession, path: str, ttl: str = "1 hour", now: datetime | None = None) -> DataFrame:
    """Newest price per symbol that has traded within ``ttl``; now is the broker's newest time unless given."""
    seen = spark.read.parquet(path).select(COLUMNS)
    return latest_price(seen, ttl, now, tolerance="100 years")
