"""Open/high/low/close/volume bars, whole or from parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.skew import left_lookup
from tapeworks.functions.sums import exact_sum

BAR_COLUMNS = ["symbol", "minute", "open", "high", "low", "close", "volume", "trade_count"]


def _edge(value: str, at: str, tie: str) -> Column:
    """A value with its place in time; the smallest is the open, the largest the close."""
    return F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("at"), F.col(tie).alias("tie"),
                                                     F.col(value).alias("value")))


def _bucket(df: DataFrame, ts: str, width: str) -> DataFrame:
    return df.groupBy("symbol", F.window(ts, width).alias("bucket"))


def partial_bars(trades: DataFrame, width: str = "1 minute", ts: str = "trade_ts") -> DataFrame:
    """Bars that can be merged later: they keep when, and by which trade, they opened and closed.

    Trades at the same time are ordered by trade id.
    """
    place = _edge("price", ts, "trade_id")
    grouped = _bucket(trades, ts, width).agg(
        F.min(place).alias("first"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max(place).alias("last"),
        exact_sum(F.col("quantity")).alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
    )
    return grouped.select(
        "symbol", F.col("bucket.start").alias("minute"),
        F.col("first.value").alias("open"), "high", "low", F.col("last.value").alias("close"),
        "volume", "trade_count",
        F.col("first.at").alias("open_ts"), F.col("first.tie").alias("open_id"),
        F.col("last.at").alias("close_ts"), F.col("last.tie").alias("close_id"),
    )


def merge_bars(partials: DataFrame, width: str = "1 minute") -> DataFrame:
    """One bar per symbol and bucket from any number of partial bars, also into wider buckets.

    The result is again partial, so merging can be repeated.
    """
    grouped = _bucket(partials, "minute", width).agg(
        F.min(_edge("open", "open_ts", "open_id")).alias("first"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max(_edge("close", "close_ts", "close_id")).alias("last"),
        exact_sum(F.col("volume")).alias("volume"),
        F.sum("trade_count").alias("trade_count"),
    )
    return grouped.select(
        "symbol", F.col("bucket.start").alias("minute"),
        F.col("first.value").alias("open"), "high", "low", F.col("last.value").alias("close"),
        "volume", "trade_count",
        F.col("first.at").alias("open_ts"), F.col("first.tie").alias("open_id"),
        F.col("last.at").alias("close_ts"), F.col("last.tie").alias("close_id"),
    )


def ohlcv(trades: DataFrame, width: str = "1 minute", ts: str = "trade_ts") -> DataFrame:
    """Finished bars."""
    return partial_bars(trades, width, ts).select(BAR_COLUMNS)


def open_close(trades: DataFrame, width: str = "1 minute", ts: str = "trade_ts") -> DataFrame:
    place = _edge("price", ts, "trade_id")
    return _bucket(trades, ts, width).agg(F.min(place).alias("first"), F.max(place).alias("last")).select(
        "symbol", F.col("bucket.start").alias("minute"),
        F.col("first.value").alias("open"), F.col("last.value").alias("close"),
    )


def high_low_volume(trades: DataFrame, width: str = "1 minute", ts: str = "trade_ts") -> DataFrame:
    """The parts without an order: fixed-width buffers, so a pure hash aggregate."""
    return _bucket(trades, ts, width).agg(
        F.max("price").alias("high"), F.min("price").alias("low"),
        exact_sum(F.col("quantity")).alias("volume"), F.count(F.lit(1)).alias("trade_count"),
    ).select("symbol", F.col("bucket.start").alias("minute"), "high", "low", "volume", "trade_count")


# What the trades of a bucket are, whatever their order: the sums of the two halves of a hash of each.
CONTENT = ("content_high", "content_low")


def _content(ts: str) -> list[Column]:
    digest = F.xxhash64("trade_id", "price", "quantity", ts)
    halves = F.shiftrightunsigned(digest, 32), digest.bitwiseAND(F.lit((1 << 32) - 1))
    return [F.sum(half).alias(name) for half, name in zip(halves, CONTENT)]


def contents(trades: DataFrame, width: str = "1 minute", ts: str = "trade_ts") -> DataFrame:
    """(symbol, minute, trade_count, content): which trades make up each bucket, however often each came.

    Sums of whole numbers, equal for equal trades in any order and any number of parts; a hash aggregate.
    """
    return _bucket(trades, ts, width).agg(F.count(F.lit(1)).alias("trade_count"), *_content(ts)).select(
        "symbol", F.col("bucket.start").alias("minute"), "trade_count", *CONTENT)


def traced_bars(trades: DataFrame, width: str = "1 minute", ts: str = "trade_ts") -> DataFrame:
    """Finished bars with what :func:`repair_bars` knows their trades by."""
    place = _edge("price", ts, "trade_id")
    return _bucket(trades, ts, width).agg(
        F.min(place).alias("first"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max(place).alias("last"), exact_sum(F.col("quantity")).alias("volume"),
        F.count(F.lit(1)).alias("trade_count"), *_content(ts),
    ).select("symbol", F.col("bucket.start").alias("minute"), F.col("first.value").alias("open"), "high", "low",
             F.col("last.value").alias("close"), "volume", "trade_count", *CONTENT)


def repair_bars(bars: DataFrame, trades: DataFrame, width: str = "1 minute", ts: str = "trade_ts") -> DataFrame:
    """Bars that agree with the trades: good ones are kept, missing or differing ones rebuilt.

    A bar is good if it was made of the very trades of its bucket, each as often as it is there. Bars that do not say
    what they were made of (see :func:`traced_bars`) are all rebuilt. Bars of buckets without trades are dropped.
    """
    keys, facts = ["symbol", "minute"], ["trade_count", *CONTENT]
    if not set(CONTENT) <= set(bars.columns):
        return ohlcv(trades, width, ts)
    truth = contents(trades, width, ts).select(
        *keys, *[F.col(c).alias(f"true_{c}") for c in facts], F.col("trade_count").alias("expected")
    )
    same = F.lit(True)
    for c in facts:
        same = same & F.col(c).eqNullSafe(F.col(f"true_{c}"))
    # A null symbol is one like any other.
    stored = bars.select(F.col("symbol").alias("of"), F.col("minute").alias("at"), *BAR_COLUMNS[2:], *CONTENT)
    compared = truth.join(stored, F.col("symbol").eqNullSafe(F.col("of")) & (F.col("minute") == F.col("at")), "left")
    good = compared.filter(same).select(BAR_COLUMNS)
    stale = compared.filter(~same).select(*keys, "expected")
    placed = trades.withColumn("minute", F.window(ts, width)["start"])
    unnamed = placed.filter(F.col("symbol").isNull()).select(trades.columns)
    again = left_lookup(placed, stale, keys, "expected").filter(F.col("found").isNotNull()).select(trades.columns)
    of_none = ohlcv(unnamed, width, ts).join(stale.filter(F.col("symbol").isNull()).select("minute"), "minute", "left_semi")
    return good.unionByName(ohlcv(again, width, ts)).unionByName(of_none)
