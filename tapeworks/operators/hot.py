"""Parsing for the hot path: trades as sent, no cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.payload import parse_payload
from tapeworks.functions.times import event_time, from_millis, whole_second
from tapeworks.schemas import HOT_TRADE, QUOTE_CONTRACT, TRADE_PAYLOAD


def to_trades(df: DataFrame, value: str = "raw_value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Payload fields as they came, event time with its milliseconds."""
    parsed = parse_payload(df, TRADE_PAYLOAD, value, keep)
    when = event_time(F.col("trade_ts"), F.col("timestamp"))
    return parsed.withColumn("trade_ts", when).select(*HOT_TRADE.fieldNames(), *keep)


def to_hot(df: DataFrame, value: str = "raw_value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Hot trades: as :func:`to_trades`, event time floored to the second as the hot column is."""
    return to_trades(df, value, keep).withColumn("trade_ts", whole_second(F.col("trade_ts")))


def _lacking() -> Column:
    """The columns of the hot table in which a row has no value; NaN is one."""
    return F.array_compact(F.array(*[
        F.when(F.col(name).isNull(), F.lit(f"missing_{name}")) for name in HOT_TRADE.fieldNames()
    ]))


def storable(hot: DataFrame) -> DataFrame:
    """Rows with a value in every column; the hot table has no nullable column."""
    return hot.filter(F.size(_lacking()) == 0)


def unstorable(hot: DataFrame) -> DataFrame:
    """All other rows, with what each lacks as ``reasons``."""
    return hot.withColumn("reasons", F.array_join(_lacking(), ",")).filter("reasons <> ''")


def to_quotes(df: DataFrame, value: str = "raw_value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Quotes with a millisecond event time."""
    parsed = parse_payload(df, QUOTE_CONTRACT.schema, value, keep)
    return parsed.select("symbol", "bid", "ask", from_millis(F.col("event_ts")).alias("event_ts"), *keep)
