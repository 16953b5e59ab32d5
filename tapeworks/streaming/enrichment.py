"""Trades of a stream with the quotes that have arrived by then."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tapeworks.operators.enrich import QUOTE_FIELDS, priced, with_quotes
from tapeworks.operators.hot import to_quotes, to_trades
from tapeworks.operators.silver import LINEAGE
from tapeworks.schemas import HOT_TRADE, QUOTE
from tapeworks.sinks.files import existing, write_batch
from tapeworks.streaming.runs import start_batches

# Quotes are kept in one folder per hour of their event time.
CELL_SECONDS = 3600


def _cell(ts: str):
    return F.floor(F.unix_seconds(ts) / F.lit(CELL_SECONDS))


def start_enrichment(
    bronze: DataFrame, path: str, quotes_path: str, checkpoint: str, *, trades_topic: str = "trades_raw",
    quotes_topic: str = "market_data_raw", within: str = "10 minutes", trigger: dict | None = None,
) -> StreamingQuery:
    """Trades of each micro-batch with the newest quote of the last ``within`` that has arrived by then.

    Both topics come in one stream. Quotes are added to an ordinary table by hour and batch; a micro-batch reads
    only the hours that its own trades ask for, so its cost follows the batch and not the history. Every trade
    stays, without a quote if there is none. This is an as-of lookup, linear in trades and quotes; an interval join
    would build every pair of a trade and the quotes of its interval first. A quote that arrives after its trade's
    batch is not seen; the batch operator over Bronze gives the final answer. Hours that no trade will ask for
    any more are folders to delete.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            trades = to_trades(batch.filter(F.col("kafka_topic") == trades_topic))
            arrived = to_quotes(batch.filter(F.col("kafka_topic") == quotes_topic))
            write_batch(arrived.withColumn("cell", _cell("event_ts")), quotes_path, batch_id, ["cell"])
            # One number for each hour of the batch's trades; a wrong time adds one more, and no quotes.
            first = F.floor(F.unix_seconds(F.col("trade_ts") - F.expr(f"interval {within}")) / F.lit(CELL_SECONDS))
            asked = trades.filter(F.col("trade_ts").isNotNull()).select(first.alias("a"), _cell("trade_ts").alias("b"))
            cells = sorted({c for a, b in asked.distinct().collect() for c in range(a, b + 1)})
            paths = existing(spark, [f"{quotes_path}/cell={c}" for c in cells])
            known = spark.read.option("basePath", quotes_path).schema(QUOTE).parquet(*paths).select(QUOTE.fieldNames()) if paths else arrived.limit(0)
            write_batch(with_quotes(trades, known, within), path, batch_id)
        finally:
            batch.unpersist()

    return start_batches(bronze, step, checkpoint, trigger)


def _matcher(width: int, columns: list[str]) -> Callable:
    """What is done with the trades and quotes of a symbol and cell of time, ``width`` microseconds long."""
    def packed(rows):
        table = pa.Table.from_pandas(rows, preserve_index=False)
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema) as stream:
            stream.write_table(table)
        return out.getvalue().to_pybytes()

    def place(quotes):
        """Quotes in their order: time, ask, bid; null comes first, NaN last."""
        keys = [quotes["moment"]]
        for name in ("ask", "bid"):
            keys += [quotes[name].notna(), pd.to_numeric(quotes[name])]
        return np.lexsort([k.to_numpy() for k in reversed(keys)])

    def quoted(trades, quotes):
        quotes = quotes.iloc[place(quotes)]
        times, asked = quotes["moment"].to_numpy(), trades["moment"].to_numpy()
        last = np.searchsorted(times, asked, side="right") - 1
        found = last >= 0
        found[found] = times[last[found]] >= trades["since"].to_numpy()[found]
        for name in ("bid", "ask"):
            values = np.full(len(trades), None, dtype=object)
            values[found] = quotes[name].to_numpy(dtype=object)[last[found]]
            trades[name] = values
        return trades

    def match(key, parts, state):
        held = [pa.ipc.open_stream(state.get[0]).read_pandas()] if state.exists else []
        rows = pd.concat([*held, *(part[columns] for part in parts)], ignore_index=True)
        passed, end = state.getCurrentWatermarkMs() * 1000, key[1] + width - 1
        due = ~rows["is_quote"] & (rows["moment"] <= passed)
        if due.any():
            yield quoted(rows[due].drop_duplicates(), rows[rows["is_quote"]]).drop(columns=["is_quote", "since"])
        rest = rows[~due]
        if end <= passed or rest.empty:
            if state.exists:
                state.remove()
            return
        waiting = rest.loc[~rest["is_quote"], "moment"]
        state.update((packed(rest),))
        state.setTimeoutTimestamp(max(-(-int(waiting.min() if len(waiting) else end) // 1000) - 1, 1))

    return match


def with_late_quotes(
    bronze: DataFrame, delay: str, *, trades_topic: str = "trades_raw", quotes_topic: str = "market_data_raw",
    within: str = "10 minutes",
) -> DataFrame:
    """A stream of trades, each once, with the newest quote of the last ``within``, whenever that has arrived.

    Trades and quotes wait in state until both watermarks have passed a trade, so a quote that comes up to ``delay``
    later than others still reaches it; then the trade appears, without a quote if there is none. The state holds
    ``within`` and ``delay`` of both streams, by symbol and cell of time, as long as ``within``; a quote waits in each
    cell that it may serve, mostly two. There the trades are looked up in the sorted quotes, so work and state are linear
    in both, and no pairs are built. What is later than ``delay`` is left out. Trades without a time cannot wait and
    appear at once; the columns that tell records apart stay.
    """
    trades = to_trades(bronze.filter(F.col("kafka_topic") == trades_topic), keep=LINEAGE)
    quotes = to_quotes(bronze.filter(F.col("kafka_topic") == quotes_topic)).filter("symbol IS NOT NULL AND event_ts IS NOT NULL")
    names, span = [*HOT_TRADE.fieldNames(), *LINEAGE], F.expr(f"interval {within}")
    kinds = {**dict(trades.dtypes), **dict(quotes.dtypes)}
    width = bronze.sparkSession.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + span)).first()[0]

    def cell(ts: Column) -> Column:
        return F.unix_micros(ts) - F.pmod(F.unix_micros(ts), F.lit(width))

    def waiting(rows: DataFrame, ts: str) -> DataFrame:
        # A wrong time that pandas cannot hold must not stop the stream.
        clock = F.greatest(F.least(F.col(ts), F.lit("2262-01-01").cast("timestamp")), F.lit("1700-01-01").cast("timestamp"))
        return rows.withColumn("at", clock).withWatermark("at", delay)

    # Values pass through Python as text, so that null, NaN and every digit stay.
    texts = [c for c in names if c != "trade_ts"]
    asking = waiting(trades.filter("trade_ts IS NOT NULL"), "trade_ts").select(
        "at", cell(F.col("trade_ts")).alias("cell"), F.lit(False).alias("is_quote"), F.unix_micros("trade_ts").alias("moment"),
        F.unix_micros(F.col("trade_ts") - span).alias("since"), *[F.col(c).cast("string") for c in texts],
        *[F.lit(None).cast("string").alias(c) for c in QUOTE_FIELDS])
    cells = F.sequence(cell(F.col("event_ts")), cell(F.col("event_ts") + span), F.lit(width))
    known = waiting(quotes, "event_ts").select(
        "at", F.explode(cells).alias("cell"), F.lit(True).alias("is_quote"), F.unix_micros("event_ts").alias("moment"),
        F.unix_micros("event_ts").alias("since"), *[(F.col(c) if c == "symbol" else F.lit(None).cast("string")).alias(c) for c in texts],
        *[F.col(c).cast("string") for c in QUOTE_FIELDS])
    columns = ["is_quote", "moment", "since", *texts, *QUOTE_FIELDS]
    out = T.StructType([T.StructField("moment", T.LongType()), *[T.StructField(c, T.StringType()) for c in (*texts, *QUOTE_FIELDS)]])
    found = asking.unionByName(known).groupBy("symbol", "cell").applyInPandasWithState(
        _matcher(width, columns), out, "held binary", "append", "EventTimeTimeout")
    found = found.select(
        *[(F.timestamp_micros("moment") if c == "trade_ts" else F.col(c).cast(kinds[c])).alias(c) for c in names],
        F.struct(*[F.col(c).cast(kinds[c]).alias(c) for c in QUOTE_FIELDS]).alias("quote"))
    timeless = trades.filter("trade_ts IS NULL").withColumn("quote", F.lit(None).cast(found.schema["quote"].dataType))
    return priced(found.unionByName(timeless), names)
