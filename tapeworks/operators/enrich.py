"""Trades with the quote that prevailed when they happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.skew import HOT_KEYS_AT_MOST, HOT_ROWS, dealt, hot_limit

QUOTE_FIELDS = ("bid", "ask")


def _cell(ts: str, seconds: int) -> Column:
    return F.floor(F.unix_seconds(ts) / F.lit(seconds))


def _hot_cells(counts: DataFrame, slice_rows: int) -> DataFrame:
    """Cells that one task should not hold, and into how many slices to cut each."""
    limit = hot_limit(counts, "trades", slice_rows)
    return counts.filter(F.col("trades") > limit).select(
        "symbol", "cell", F.ceil(F.col("trades") / limit).cast("int").alias("slices")
    )


def _inherited(counts: DataFrame, quotes: DataFrame) -> DataFrame:
    """The quote with which each cell that has trades begins: the last one of any earlier cell.

    The window is over one row per symbol and cell, so a symbol's share grows with the calendar only.
    """
    # The count is read here too, so that the plan finds the counting shuffle it has already done.
    cells = counts.select("symbol", "cell", (F.col("trades") > 0).alias("wanted")).unionByName(
        quotes.groupBy("symbol", "cell").agg(F.max("quote").alias("quote")).withColumn("wanted", F.lit(False)),
        allowMissingColumns=True,
    )
    earlier = Window.partitionBy("symbol").orderBy("cell").rangeBetween(Window.unboundedPreceding, -1)
    begun = cells.withColumn("quote", F.last("quote", ignorenulls=True).over(earlier))
    return begun.filter(F.col("wanted") & F.col("quote").isNotNull()).select("symbol", "cell", "quote")


def _in_every_slice(rows: DataFrame, hot: DataFrame) -> DataFrame:
    cut = rows.join(F.broadcast(hot), ["symbol", "cell"], "left")
    numbers = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
    return cut.withColumn("slice", F.explode(numbers)).drop("slices")


def prevailing_quotes(
    trades: DataFrame, quotes: DataFrame, cell_seconds: int = 900, slice_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``quote``, the newest quote of the symbol at or before the trade, or NULL.

    Trades are shuffled once, and no task holds all rows of a symbol:

    * the running "last quote" is taken inside one symbol and one cell of time; what a cell inherits from
      earlier ones comes in as one more quote at its beginning;
    * trades of a hot cell are dealt out over slices, each of which gets the cell's quotes. The list of hot
      cells is broadcast: by its definition it has at most ten thousand rows. Quotes are first reduced to one
      per symbol and time, so that a cell has at most 1,000 a second, against a million trades a slice.

    Several quotes of a symbol at the same time count as one: the one with the largest (ask, bid).
    """
    newest = F.struct("event_ts", *reversed(QUOTE_FIELDS))
    ticks = (
        quotes.filter(F.col("symbol").isNotNull() & F.col("event_ts").isNotNull())
        .groupBy("symbol", F.col("event_ts").alias("at")).agg(F.max(newest).alias("quote"))
        .withColumn("cell", _cell("at", cell_seconds))
    )
    placed = trades.withColumn("cell", _cell("trade_ts", cell_seconds))
    nowhere = F.col("symbol").isNull() | F.col("cell").isNull()
    counts = placed.filter(~nowhere).groupBy("symbol", "cell").agg(F.count(F.lit(1)).alias("trades"))
    hot = _hot_cells(counts, slice_rows)

    slices = F.when(nowhere, F.lit(HOT_KEYS_AT_MOST)).otherwise(F.coalesce("slices", F.lit(1)))
    asking = placed.join(F.broadcast(hot), ["symbol", "cell"], "left").select(
        *trades.columns, "cell", dealt(trades.columns, slices).alias("slice"),
        F.col("trade_ts").alias("at"), F.lit(2).alias("turn"),
    )
    first = F.timestamp_seconds(F.col("cell") * cell_seconds)
    begins = _inherited(counts, ticks).withColumns({"at": first, "turn": F.lit(0)})
    known = _in_every_slice(begins.unionByName(ticks.withColumn("turn", F.lit(1))), hot)

    so_far = Window.partitionBy("symbol", "cell", "slice").orderBy("at", "turn").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        asking.unionByName(known, allowMissingColumns=True)
        .withColumn("quote", F.last("quote", ignorenulls=True).over(so_far))
        .filter("turn = 2")
        .select(*trades.columns, "quote")
    )


def _slippage(side: Column, price: Column, mid: Column) -> Column:
    """What a trade paid above, or received below, the middle of the quote."""
    side = F.lower(F.trim(side))
    return F.when(side == "buy", price - mid).when(side == "sell", mid - price)


def with_quotes(trades: DataFrame, quotes: DataFrame, within: str | None = None, **sizes: int) -> DataFrame:
    """Add bid, ask, mid, spread and slippage of the newest quote at or before the trade.

    Trades without such a quote, or with none in the last ``within`` (an interval such as ``10 minutes``),
    stay with NULLs.
    """
    quote = F.col("quote")
    if within is not None:
        recent = F.col("quote.event_ts") >= F.col("trade_ts") - F.expr(f"interval {within}")
        quote = F.when(recent, quote)
    return priced(prevailing_quotes(trades, quotes, **sizes).withColumn("quote", quote), trades.columns)


def priced(found: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of a trade, and what its ``quote`` says of it."""
    joined = found.select(*columns, *[F.col(f"quote.{f}").alias(f) for f in QUOTE_FIELDS])
    mid = (F.col("bid") + F.col("ask")) / 2
    return joined.withColumns({
        "mid": mid,
        "spread": F.col("ask") - F.col("bid"),
        "slippage": _slippage(F.col("side"), F.col("price"), mid),
    })


def to_payload(enriched: DataFrame) -> DataFrame:
    """Key and JSON value, ready for a topic."""
    return enriched.select(
        F.col("symbol").alias("key"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )
