"""Bars kept up to date from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tapeworks.operators.bars import BAR_COLUMNS, merge_bars, partial_bars, traced_bars
from tapeworks.sinks.files import compact, month_batch_writer
from tapeworks.streaming.runs import TIER, BatchStep, in_tiers, start_batches


def start_bars(
    trades: DataFrame, path: str, checkpoint: str, width: str = "1 minute", trigger: dict | None = None
) -> StreamingQuery:
    """Each micro-batch adds its partial bars; :func:`read_bars` merges them.

    No state is kept and no row is too late: a bucket spread over several batches has several parts, until these are
    merged (see :func:`~tapeworks.streaming.runs.in_tiers`). A batch that is repeated replaces its own parts.
    """
    return start_batches(trades, bars_step(path, width), checkpoint, trigger)


def bars_step(path: str, width: str = "1 minute", tier: int = TIER) -> BatchStep:
    """Writes the partial bars of a batch, and merges those of earlier batches by symbol and bucket."""
    write = month_batch_writer(path, "minute")
    return in_tiers(lambda batch, batch_id: write(partial_bars(batch, width), batch_id), path, "month",
                    lambda parts: merge_bars(parts, width), tier)


def compact_bars(spark: SparkSession, path: str, months: list[int], width: str = "1 minute") -> None:
    """Merge the parts of finished months into one per bucket, in few files; see :func:`~tapeworks.sinks.files.compact`."""
    for month in months:
        compact(spark, path, "month", str(month), lambda parts: merge_bars(parts, width))


def read_bars(spark: SparkSession, path: str, width: str = "1 minute", months: list[int] | None = None) -> DataFrame:
    """One row per symbol and bucket from all parts, of the given months (yyyymm) only if named."""
    parts = spark.read.parquet(path)
    if months is not None:
        parts = parts.filter(parts.month.isin(months))
    return merge_bars(parts, width).select(BAR_COLUMNS)


def closed_bars(trades: DataFrame, delay: str, width: str = "1 minute", ts: str = "trade_ts") -> DataFrame:
    """A stream of finished bars: each appears once, when the watermark has passed its end.

    Trades later than ``delay`` are not counted; ``repair_bars`` puts that right from Bronze, by the trades that each
    bar says it is made of.
    """
    return traced_bars(trades.withWatermark(ts, delay), width, ts)
