"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs once to warm up and then twice; the
better time counts. Results go to a sink that discards them, so that every row and column is computed.
"""

import json
import os
import time

from pyspark.sql import functions as F

from tapeworks.operators import gold, quality, silver
from tapeworks.plans import fixtures
from tapeworks.plans.catalog import all_queries
from tapeworks.plans.replay import replay_shuffled
from tapeworks.session import local_session, workspace
from tapeworks.sinks import files
from tapeworks.sources.envelope import read_envelope_files
from tapeworks.streaming import runs
from tapeworks.streaming.dual_sink import start_dual_sink

HEADLINE = [
    "daily_trade_metrics", "silver_dedupe", "silver_trades", "silver_rejects", "silver_parse", "stage_counts",
    "hot_parse", "ohlcv_1m", "high_low_volume", "bars_merge", "ohlcv_rollup", "trades_enriched",
    "quality_not_null", "quality_required", "quality_unique", "contract_violations", "schema_profile",
    "latest_price", "portfolio_summary", "daily_pnl", "risk_metrics", "quote_bars", "hot_layout",
    "silver_incremental", "run_daily", "dual_sink_hot", "ohlcv_stream",
]
RUNS = 2


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stored_gold_check(spark, sf_dir: str) -> float:
    """The not-null checks alone, on a Gold table that is already there."""
    metrics = files.staged(
        gold.daily_trade_metrics(fixtures.silver_trades(spark, sf_dir)), workspace(spark, "bench-gold")
    )
    rules = quality.not_null("trade_date", "symbol")
    return min(seconds(lambda *_: quality.check(metrics, rules), spark, sf_dir) for _ in range(RUNS + 1))


def slowest_micro_batch(spark, sf_dir: str) -> float:
    """From taking a quarter of the records to having them in Bronze and in the hot table."""
    bronze, hot, checkpoint = (workspace(spark, f"bench-{name}") for name in ("bronze", "hot", "checkpoint"))
    started = []

    def start(stream):
        started.append(start_dual_sink(
            stream, files.bronze_batch_writer(bronze), files.month_batch_writer(hot, "trade_ts"), checkpoint,
            runs.CATCH_UP,
        ))
        return started[-1]

    replay_shuffled(fixtures.trades_envelope(spark, sf_dir), start)
    return max(p.batchDuration for p in started[0].recentProgress) / 1000


def cold_parse(spark, sf_dir: str) -> float:
    """Parsing alone of the records that the rejects and the counts are worked out from."""
    return min(seconds(lambda *_: silver.flagged(fixtures.cold_bronze(spark, sf_dir)), spark, sf_dir)
               for _ in range(RUNS + 1))


def event_to_sink(spark, sf_dir: str, parts: int = 3) -> float:
    """From the arrival of records at the source to their being in Bronze and the hot table, at the usual trigger."""
    source, bronze, hot, checkpoint = (workspace(spark, f"bench-e2e-{n}") for n in ("source", "bronze", "hot", "checkpoint"))
    envelope = fixtures.trades_envelope(spark, sf_dir)
    part = F.pmod(F.xxhash64("partition", "offset"), F.lit(10 * parts))
    envelope.filter(part >= parts).limit(1).write.parquet(source)
    stored = {}
    query = start_dual_sink(
        read_envelope_files(spark, source, stream=True), files.bronze_batch_writer(bronze),
        files.month_batch_writer(hot, "trade_ts"), checkpoint, report=lambda batch, counts: stored.update({batch: counts["hot"]}))
    slowest = 0.0
    try:
        while not stored:
            time.sleep(0.05)
        for i in range(parts):
            seen = len(stored)
            envelope.filter(part == i).coalesce(2).write.mode("append").parquet(source)
            start = time.perf_counter()
            while len(stored) == seen:
                time.sleep(0.02)
            slowest = max(slowest, time.perf_counter() - start)
    finally:
        query.stop()
    return slowest


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    queries = all_queries()
    times = {}
    for name in HEADLINE:
        seconds(queries[name], spark, sf_dir)
        times[name] = round(min(seconds(queries[name], spark, sf_dir) for _ in range(RUNS)), 3)
    times["stored_gold_not_null_check"] = round(stored_gold_check(spark, sf_dir), 3)
    times["dual_sink_slowest_micro_batch"] = round(slowest_micro_batch(spark, sf_dir), 3)
    times["cold_parse"] = round(cold_parse(spark, sf_dir), 3)
    times["event_to_sink_slowest"] = round(event_to_sink(spark, sf_dir), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
