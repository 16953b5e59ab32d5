"""Live cards that forget: newest prices that expire in state, and volumes of the last hour from panes of a minute."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks.functions.sums import exact_sum
from tapeworks.operators.marts import TOLERANCE
from tapeworks.sinks.files import merge_batches, write_batch
from tapeworks.streaming.runs import TIER, BatchStep, start_batches

PRICE_COLUMNS = ["symbol", "price", "trade_ts", "trade_id"]
CHANGE = "symbol string, price double, at long, trade_id string, removed boolean"
PANE = "1 minute"


def _micros(interval: str) -> int:
    """Length of an interval of days, hours, minutes and so on; months have none."""
    return pd.Timedelta(interval).value // 1000


def _sane(tolerance: str):
    return F.coalesce(F.col("trade_ts") <= F.col("source_ts") + F.expr(f"interval {tolerance}"), F.lit(False))


def _price_keeper(ttl_micros: int, delay_ms: int) -> Callable:
    """What is done with the rows of a symbol, and when it has timed out; the watermark is ``delay_ms`` behind the clock."""
    def change(key, last):
        at, trade_id, price = last or (None, None, None)
        return pd.DataFrame({"symbol": pd.Series([key[0]], dtype=object), "price": pd.Series([price], dtype="Float64"),
                             "at": pd.Series([at], dtype="Int64"), "trade_id": pd.Series([trade_id], dtype=object),
                             "removed": [last is None]})

    def place(last):
        return last[0], last[1] is not None, last[1] or ""

    def keep(key, parts, state):
        known = state.get if state.exists else None
        best = known
        for rows in parts:
            seen = rows[rows["at"].notna()]
            for last in zip(map(int, seen["at"]), seen["trade_id"], map(float, seen["price"])):
                if best is None or place(last) > place(best):
                    best = last
        if best is None:
            return
        until = max((best[0] + ttl_micros) // 1000 - delay_ms, 1)
        if state.hasTimedOut or until < state.getCurrentWatermarkMs():
            if known is not None:
                state.remove()
                yield change(key, None)
            return
        if best != known:
            state.update(best)
            yield change(key, best)
        state.setTimeoutTimestamp(until)

    return keep


def _newest_of_batch() -> Callable:
    """One row for each symbol of every Arrow batch, so that a hot symbol is few rows in the shuffle: its newest
    trade, and the newest time of the broker.
    """
    def newest(batches):
        for rows in batches:
            by_symbol = rows.assign(clock=rows.groupby("symbol", dropna=False)["clock"].transform("max"),
                                    named=rows["trade_id"].notna(), name=rows["trade_id"].fillna(""))
            ordered = by_symbol.sort_values(["at", "named", "name"], na_position="first")
            yield ordered.drop_duplicates("symbol", keep="last")[["symbol", "at", "trade_id", "price", "clock"]]
    return newest


def price_changes(trades: DataFrame, ttl: str = "1 hour", tolerance: str = TOLERANCE) -> DataFrame:
    """A stream of (symbol, price, trade_ts, trade_id, removed): each symbol's new newest price, or that it has gone.

    State holds one row for each symbol that has traded within ``ttl`` of the broker's newest time; a timeout takes it
    out, to the millisecond, without waiting for another trade of that symbol. The watermark stands ``ttl`` and
    ``tolerance`` behind that time, so what it drops as late would have expired anyway. Trades ahead of the broker's
    clock, or without a price, move the clock only. A symbol changes once in a batch.
    """
    delay_ms = (_micros(ttl) + _micros(tolerance)) // 1000
    counts = _sane(tolerance) & F.col("price").isNotNull()
    places = trades.filter("source_ts IS NOT NULL").select(
        "symbol", F.when(counts, F.unix_micros("trade_ts")).alias("at"), F.when(counts, F.col("trade_id")).alias("trade_id"),
        F.when(counts, F.col("price")).alias("price"), F.unix_micros("source_ts").alias("clock"))
    few = places.mapInPandas(_newest_of_batch(), places.schema)
    timed = few.withColumn("clock", F.timestamp_micros("clock")).withWatermark("clock", f"{delay_ms} milliseconds")
    changes = timed.groupBy("symbol").applyInPandasWithState(
        _price_keeper(_micros(ttl), delay_ms), CHANGE, "at long, trade_id string, price double", "update", "EventTimeTimeout")
    return changes.select("symbol", "price", F.timestamp_micros("at").alias("trade_ts"), "trade_id", "removed")


def current_prices(changes: DataFrame) -> DataFrame:
    """Of the changes that batches have written, the last of each symbol, without those that have gone."""
    last = F.max_by(F.struct("price", "trade_ts", "trade_id", "removed", "version"), "version")
    return changes.groupBy("symbol").agg(last.alias("last")).select("symbol", "last.*").filter("NOT removed")


def _with_snapshots(path: str, merge: Callable[[DataFrame], DataFrame], every: int = TIER) -> BatchStep:
    """Writes the changes of each batch; every so often all that is there becomes one folder, of live rows only.

    So the folder holds the live rows and at most ``every`` batches, however long the stream runs.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % every == 0:
            merge_batches(batch.sparkSession, path, 0, batch_id - 1, merge=merge)
        write_batch(batch.withColumn("version", F.lit(batch_id).cast("bigint")), path, batch_id)
    return run


def start_live_prices(
    trades: DataFrame, path: str, checkpoint: str, ttl: str = "1 hour", tolerance: str = TOLERANCE,
    trigger: dict | None = None, every: int = TIER,
) -> StreamingQuery:
    """Newest prices in a folder, read by :func:`read_live_prices`; state and folder hold live symbols only."""
    return start_batches(price_changes(trades, ttl, tolerance), _with_snapshots(path, current_prices, every), checkpoint,
                         trigger, mode="update")


def read_live_prices(spark: SparkSession, path: str) -> DataFrame:
    """Newest price of each symbol that has not expired; no clock is looked at."""
    return current_prices(spark.read.parquet(path)).select(PRICE_COLUMNS)


def volume_panes(trades: DataFrame, window: str = "1 hour", tolerance: str = TOLERANCE) -> DataFrame:
    """A stream of sums by symbol and minute, each as it stands after a batch, for as long as a window may ask for it.

    Spark's aggregate combines them before the shuffle and drops them from state when the window has left them for
    good. Trades ahead of the broker's clock count nothing, but the broker's time of theirs does.
    """
    sane = _sane(tolerance)
    waiting = f"{(_micros(window) + _micros(tolerance) + _micros(PANE)) // 1000} milliseconds"
    placed = trades.select("symbol", "source_ts", sane.alias("counts"), F.when(sane, F.col("trade_ts")).otherwise(F.col("source_ts")).alias("at"),
                           F.when(sane, F.col("quantity")).alias("quantity"), F.when(sane, F.col("price")).alias("price"))
    return placed.withWatermark("at", waiting).groupBy("symbol", F.window("at", PANE).alias("pane")).agg(
        exact_sum(F.col("quantity")).alias("volume"), exact_sum(F.col("price") * F.col("quantity")).alias("notional"),
        F.count_if("counts").alias("trades"), F.max("source_ts").alias("source_ts"),
    ).select("symbol", F.col("pane.start").alias("minute"), "volume", "notional", "trades", "source_ts")


def live_panes(panes: DataFrame, window: str = "1 hour") -> DataFrame:
    """Of the panes that batches have written, the last state of each; those that no window asks for again go.

    A pane that holds the broker's newest time stays, however old it is: it is the clock.
    """
    last = F.max_by(F.struct("volume", "notional", "trades", "source_ts", "version"), "version")
    now = panes.select(F.max("source_ts")).scalar()
    wanted = F.col("minute") >= F.date_trunc("minute", now) - F.expr(f"interval {window}")
    return panes.filter(wanted | (F.col("source_ts") == now)).groupBy("symbol", "minute").agg(last.alias("last")).select(
        "symbol", "minute", "last.*")


def start_live_volume(
    trades: DataFrame, path: str, checkpoint: str, window: str = "1 hour", tolerance: str = TOLERANCE,
    trigger: dict | None = None, every: int = TIER,
) -> StreamingQuery:
    """Panes in a folder, read by :func:`read_live_volume`; state and folder hold one window of them."""
    step = _with_snapshots(path, lambda panes: live_panes(panes, window), every)
    return start_batches(volume_panes(trades, window, tolerance), step, checkpoint, trigger, mode="update")


def read_live_volume(spark: SparkSession, path: str, window: str = "1 hour", now: datetime | None = None) -> DataFrame:
    """Quantity and notional by symbol in the ``window`` up to the running minute: what ``live_volume`` gives for the
    start of that minute as now. The minute is that of the broker's newest time unless given.
    """
    panes = spark.read.parquet(path)
    clock = F.lit(now).cast("timestamp") if now is not None else panes.select(F.max("source_ts")).scalar()
    asked = F.col("minute") >= F.date_trunc("minute", clock) - F.expr(f"interval {window}")
    return live_panes(panes, window).filter(asked & (F.col("trades") > 0)).groupBy("symbol").agg(
        exact_sum(F.col("volume")).alias("volume"), exact_sum(F.col("notional")).alias("notional"),
        F.sum("trades").alias("trades"))
