"""Silver to Gold: daily metrics per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.sums import exact_sum


def trade_date() -> Column:
    """Day of the broker time, else of the ingestion time, in the session zone (UTC)."""
    return F.coalesce(F.to_date("source_ts"), F.to_date("ingestion_time"))


def _part(side: str, amount: Column) -> Column:
    return F.when(F.lower("side") == side, amount).otherwise(F.lit(0.0))


def gold_base(silver: DataFrame, *carry: str) -> DataFrame:
    """Date, symbol and each trade's quantity and notional split by side."""
    quantity, notional = F.col("quantity"), F.col("price") * F.col("quantity")
    return silver.filter(F.coalesce("source_ts", "ingestion_time").isNotNull()).select(
        trade_date().alias("trade_date"),
        "symbol",
        _part("buy", quantity).alias("buy_qty_part"),
        _part("sell", quantity).alias("sell_qty_part"),
        _part("buy", notional).alias("buy_notional_part"),
        _part("sell", notional).alias("sell_notional_part"),
        *carry,
    )


def side_sums() -> list[Column]:
    """Aggregates over the parts of :func:`gold_base`."""
    return [exact_sum(F.col(f"{name}_part")).alias(name) for name in
            ("buy_qty", "sell_qty", "buy_notional", "sell_notional")]


def side_metrics() -> dict[str, Column]:
    """What follows from the four sums. A side without volume has no average price."""
    return {
        "net_qty": F.col("buy_qty") - F.col("sell_qty"),
        "gross_notional": F.col("buy_notional") + F.col("sell_notional"),
        "avg_buy_price": F.when(F.col("buy_qty") > 0, F.col("buy_notional") / F.col("buy_qty")),
        "avg_sell_price": F.when(F.col("sell_qty") > 0, F.col("sell_notional") / F.col("sell_qty")),
    }


def daily_trade_metrics(silver: DataFrame) -> DataFrame:
    """One row per day and symbol: one aggregate, combined before its only shuffle."""
    totals = gold_base(silver).groupBy("trade_date", "symbol").agg(
        F.count(F.lit(1)).alias("trades"), *side_sums()
    )
    return totals.withColumns({**side_metrics(), "ingested_at": F.current_timestamp()}).select(
        "trade_date", "symbol", "trades",
        "buy_qty", "sell_qty", "net_qty",
        "buy_notional", "sell_notional", "gross_notional",
        "avg_buy_price", "avg_sell_price", "ingested_at",
    )


def daily_fees(silver: DataFrame, rate: float = 0.0000125, decimals: int = 9) -> DataFrame:
    """Fees per day and symbol: a share of each trade's notional, to ``decimals`` places, summed without loss."""
    fee = F.round(F.col("price") * F.col("quantity") * F.lit(rate), decimals)
    dated = silver.filter(F.coalesce("source_ts", "ingestion_time").isNotNull())
    return dated.groupBy(trade_date().alias("trade_date"), "symbol").agg(
        F.round(exact_sum(fee), decimals).alias("fees"))
