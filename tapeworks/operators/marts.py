"""Live cards and Gold marts. The formulas are this project's own."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.sums import exact_avg, exact_sum
from tapeworks.operators.gold import gold_base, side_metrics, side_sums

# How far a producer's clock may run ahead of the broker's.
TOLERANCE = "5 minutes"


def in_time(trades: DataFrame, tolerance: str = TOLERANCE, ts: str = "trade_ts", clock: str = "source_ts") -> DataFrame:
    """Trades whose own time is not ahead of the broker's; those ahead are for :func:`ahead_of_time`."""
    return trades.filter(F.col(ts) <= F.col(clock) + F.expr(f"interval {tolerance}"))


def ahead_of_time(trades: DataFrame, tolerance: str = TOLERANCE, ts: str = "trade_ts",
                  clock: str = "source_ts") -> DataFrame:
    """Trades that :func:`in_time` leaves out, with the reason: a time ahead of the broker's, or none."""
    late = F.col(ts) > F.col(clock) + F.expr(f"interval {tolerance}")
    reason = F.when(F.col(ts).isNull() | F.col(clock).isNull(), F.lit("missing_time")).when(late, F.lit("time_ahead"))
    return trades.withColumn("reasons", reason).filter("reasons IS NOT NULL")


def _recent(trades: DataFrame, age: str, now: datetime | None, tolerance: str) -> DataFrame:
    """Trades of the last ``age``. Now is ``now``, or the broker's newest time (a scalar subquery, no join).

    Producers set the time of a trade, the broker that of the record: so no single trade can move the clock.
    """
    newest = F.lit(now).cast("timestamp") if now is not None else trades.select(F.max("source_ts")).scalar()
    return in_time(trades, tolerance).filter(F.col("trade_ts") >= newest - F.expr(f"interval {age}"))


def _last(value: str, ts: str = "trade_ts", tie: str = "trade_id") -> Column:
    return F.max(F.when(F.col(value).isNotNull(), F.struct(F.col(ts).alias("ts"), F.col(tie).alias("tie"),
                                                           F.col(value).alias("value"))))


def latest_price(trades: DataFrame, ttl: str = "1 hour", now: datetime | None = None,
                 tolerance: str = TOLERANCE) -> DataFrame:
    """Newest price per symbol; symbols that have not traded for ``ttl`` are gone. Trades have a ``source_ts``."""
    recent = _recent(trades, ttl, now, tolerance)
    return recent.groupBy("symbol").agg(_last("price").alias("last")).select(
        "symbol", F.col("last.value").alias("price"), F.col("last.ts").alias("trade_ts"),
        F.col("last.tie").alias("trade_id"),
    )


def live_volume(trades: DataFrame, window: str = "1 hour", now: datetime | None = None,
                tolerance: str = TOLERANCE) -> DataFrame:
    """Quantity and notional per symbol over the last ``window``. Trades have a ``source_ts``."""
    recent = _recent(trades, window, now, tolerance)
    return recent.groupBy("symbol").agg(
        exact_sum(F.col("quantity")).alias("volume"),
        exact_sum(F.col("price") * F.col("quantity")).alias("notional"),
        F.count(F.lit(1)).alias("trades"),
    )


def active_positions(silver: DataFrame) -> DataFrame:
    """Bought minus sold per symbol, open positions only."""
    signed = F.when(F.col("side") == "buy", F.col("quantity")).when(F.col("side") == "sell", -F.col("quantity"))
    return silver.groupBy("symbol").agg(exact_sum(signed).alias("position")).filter(F.col("position") != 0)


def _daily(silver: DataFrame) -> DataFrame:
    """Gold sums and the day's last price in one aggregate: no join of two results on the same key."""
    return (
        gold_base(silver, "price", "trade_ts", "trade_id")
        .groupBy("trade_date", "symbol")
        .agg(*side_sums(), _last("price").alias("last"))
        .withColumns({**side_metrics(), "mark": F.col("last.value")})
        .drop("last")
    )


def daily_pnl(silver: DataFrame) -> DataFrame:
    """Cash flow of the day plus the change in value of the position, at the day's last price.

    The windows run over daily rows: a symbol has one per trading day, however many trades.
    """
    days = Window.partitionBy("symbol").orderBy("trade_date")
    position = F.sum("net_qty").over(days.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    valued = _daily(silver).withColumn("cash", F.col("sell_notional") - F.col("buy_notional")) \
        .withColumn("position", position) \
        .withColumn("market_value", F.col("position") * F.col("mark"))
    change = F.col("market_value") - F.lag("market_value", 1, 0.0).over(days)
    return valued.withColumn("pnl", F.col("cash") + change).select(
        "trade_date", "symbol", "cash", "position", "mark", "market_value", "pnl"
    )


def portfolio_summary(silver: DataFrame) -> DataFrame:
    """Position, average prices, market value and total result per symbol since the beginning."""
    totals = (
        gold_base(silver, "price", "trade_ts", "trade_id")
        .groupBy("symbol")
        .agg(*side_sums(), _last("price").alias("last"))
        .withColumns({**side_metrics(), "last_price": F.col("last.value")})
    )
    market_value = F.col("net_qty") * F.col("last_price")
    return totals.select(
        "symbol", F.col("net_qty").alias("position"),
        F.col("avg_buy_price").alias("buy_vwap"), F.col("avg_sell_price").alias("sell_vwap"),
        "last_price", market_value.alias("market_value"),
        (F.col("sell_notional") - F.col("buy_notional") + market_value).alias("total_pnl"),
    )


# Returns are squared and summed as whole numbers of this many to one.
RETURN_UNITS = 1e12


def rolling_deviation(value: str, keys: Sequence[str], order: str, rows: int) -> Column:
    """Sample deviation of the last ``rows`` values, the current one included; NULL with fewer than two.

    Count, sum and sum of squares are running totals in whole numbers of 1e-12, less the totals before the window:
    exact, the same on every run, one step for each row whatever the width. Values are within 1e5 of zero.
    """
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -rows)
    units = F.rint(F.col(value) * F.lit(RETURN_UNITS)).cast("decimal(18,0)")

    def last(total: Column) -> Column:
        return F.coalesce(total.over(so_far), F.lit(0)) - F.coalesce(total.over(before), F.lit(0))

    n = last(F.count(value))
    total, squares = last(F.sum(units)).cast("decimal(22,0)"), last(F.sum(units * units)).cast("decimal(36,0)")
    apart = (squares * n.cast("decimal(4,0)")).cast("decimal(38,0)") - (total * total).cast("decimal(38,0)")
    return F.when(n > 1, F.sqrt(apart.cast("double") / (n * (n - 1))) / F.lit(RETURN_UNITS))


def risk_metrics(silver: DataFrame, rows: int = 20) -> DataFrame:
    """Daily close return, its rolling deviation over ``rows`` days, drawdowns and gross exposure.

    Works on daily rows, like :func:`daily_pnl`.
    """
    days = Window.partitionBy("symbol").orderBy("trade_date")
    so_far = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("close").over(days)
    return (
        _daily(silver)
        .select("trade_date", "symbol", F.col("mark").alias("close"),
                F.col("gross_notional").alias("gross_exposure"))
        .withColumn("daily_return", F.when(before != 0, F.col("close") / before - 1))
        .withColumn("volatility", rolling_deviation("daily_return", ["symbol"], "trade_date", rows))
        .withColumn("drawdown", F.col("close") / F.nullif(F.max("close").over(so_far), F.lit(0.0)) - 1)
        .withColumn("max_drawdown", F.min("drawdown").over(so_far))
        .select("trade_date", "symbol", "close", "daily_return", "volatility", "drawdown", "max_drawdown",
                "gross_exposure")
    )


def quote_bars(quotes: DataFrame, width: str = "1 minute") -> DataFrame:
    """Mean, smallest and largest mid and spread per symbol and bucket, of any size; a spread is the plain difference."""
    mid, spread = (F.col("bid") + F.col("ask")) / 2, F.col("ask") - F.col("bid")
    bars = quotes.withColumns({"mid": mid, "spread": spread}).groupBy(
        "symbol", F.window("event_ts", width).alias("bucket")
    ).agg(
        exact_avg(F.col("mid")).alias("avg_mid"), F.min("mid").alias("min_mid"), F.max("mid").alias("max_mid"),
        exact_avg(F.col("spread")).alias("avg_spread"), F.min("spread").alias("min_spread"),
        F.max("spread").alias("max_spread"), F.count(F.lit(1)).alias("quotes"),
    )
    return bars.withColumn("minute", F.col("bucket.start")).drop("bucket")
