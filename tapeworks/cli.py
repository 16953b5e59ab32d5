"""Command line for spark-submit: ``stream``, ``bars``, ``latest``, ``volume``, ``enrich``, ``compact``, ``silver``, ``gold``, ``daily``.

The session, its catalogs and connectors are configured by spark-submit.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tapeworks.operators.hot import to_trades
from tapeworks.plans import jobs
from tapeworks.session import prepare
from tapeworks.sinks.files import bronze_batch_writer, month_batch_writer, write_batch
from tapeworks.sinks.jdbc import jdbc_batch_writer, jdbc_options
from tapeworks.sinks.tables import scan, table_batch_writer
from tapeworks.sources.envelope import read_topic, to_bronze
from tapeworks.streaming.bars import compact_bars, start_bars
from tapeworks.streaming.dual_sink import start_dual_sink
from tapeworks.streaming.enrichment import start_enrichment
from tapeworks.streaming.latest import start_latest_price
from tapeworks.streaming.live import start_live_prices, start_live_volume


def _is_path(target: str) -> bool:
    return "/" in target


def _bronze(spark: SparkSession, source: str) -> DataFrame:
    return spark.read.parquet(source) if _is_path(source) else scan(spark, source)


def _topic(spark: SparkSession, args: argparse.Namespace, topic: str) -> DataFrame:
    options = {"startingOffsets": args.starting_offsets, "failOnDataLoss": str(args.fail_on_data_loss).lower()}
    if args.max_offsets:
        options["maxOffsetsPerTrigger"] = args.max_offsets
    return read_topic(spark, args.servers, topic, **options)


def _trigger(args: argparse.Namespace) -> dict[str, str]:
    return {"processingTime": args.every}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tapeworks", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    stream = commands.add_parser("stream", help="topic to Bronze and the hot table")
    bars = commands.add_parser("bars", help="topic to minute bars in a folder")
    latest = commands.add_parser("latest", help="topic to the newest price of each symbol in a folder")
    volume = commands.add_parser("volume", help="topic to the volumes of the last hour, by symbol and minute, in a folder")
    enrich = commands.add_parser("enrich", help="topics of trades and quotes to trades with their quotes in a folder")
    for sub in (stream, bars, latest, volume, enrich):
        sub.add_argument("--servers", required=True)
        sub.add_argument("--topic", default="trades_raw")
        sub.add_argument("--checkpoint", required=True)
        sub.add_argument("--every", default="2 seconds")
        sub.add_argument("--max-offsets", help="records per micro-batch at most")
        sub.add_argument("--starting-offsets", default="latest", help="earliest, latest, or offsets as JSON")
        sub.add_argument("--fail-on-data-loss", action="store_true", help="stop when the broker has dropped offsets")
    for sub in (bars, latest, volume, enrich):
        sub.add_argument("--out", required=True, help="folder")
    latest.add_argument("--ttl", help="let symbols expire in state, as '1 hour'; else they do when read")
    volume.add_argument("--window", default="1 hour")
    stream.add_argument("--bronze", required=True, help="folder, or table of a configured catalog")
    stream.add_argument("--hot", required=True, help="folder, or table of the database at --jdbc-url")
    stream.add_argument("--rejects", help="folder for what the hot table cannot hold")
    stream.add_argument("--jdbc-url")
    stream.add_argument("--jdbc-driver")
    enrich.add_argument("--quotes-topic", default="market_data_raw")
    enrich.add_argument("--quotes", required=True, help="folder that keeps the quotes by hour")
    enrich.add_argument("--within", default="10 minutes")
    compact = commands.add_parser("compact", help="merge the parts of finished months of bars")
    compact.add_argument("--out", required=True, help="folder of the bars")
    compact.add_argument("--month", type=int, action="append", required=True, help="as 202405; may be repeated")

    silver = commands.add_parser("silver", help="Bronze to Silver")
    gold = commands.add_parser("gold", help="Silver to Gold, then the checks")
    daily = commands.add_parser("daily", help="Silver, Gold and checks as of a day's cut-off")
    for sub in (silver, daily):
        sub.add_argument("--bronze", required=True)
        sub.add_argument("--mode", choices=["full", "incremental"], default="full")
        sub.add_argument("--rejects", help="table of what Silver does not take; that of Silver with _rejects, if not named")
    for sub in (silver, gold, daily):
        sub.add_argument("--silver", default="lakehouse.silver.trades_clean")
        sub.add_argument("--root", help="folder of the tables, without a configured catalog")
        sub.add_argument("--since", type=datetime.fromisoformat)
    for sub in (gold, daily):
        sub.add_argument("--gold", default="lakehouse.gold.daily_trade_metrics")
    daily.add_argument("--day", type=date.fromisoformat)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = prepare(spark or SparkSession.builder.appName(f"tapeworks-{args.command}").getOrCreate())
    if args.command == "stream":
        bronze = bronze_batch_writer(args.bronze) if _is_path(args.bronze) else table_batch_writer(args.bronze)
        if args.jdbc_url:
            driver = {"driver": args.jdbc_driver} if args.jdbc_driver else {}
            hot = jdbc_batch_writer(jdbc_options(args.jdbc_url, args.hot, **driver))
        else:
            hot = month_batch_writer(args.hot, "trade_ts")
        lost = (lambda df, batch_id: write_batch(df, args.rejects, batch_id)) if args.rejects else None
        start_dual_sink(
            _topic(spark, args, args.topic), bronze, hot, args.checkpoint, _trigger(args), write_rejects=lost
        ).awaitTermination()
    elif args.command == "bars":
        trades = to_trades(_topic(spark, args, args.topic), "value")
        start_bars(trades, args.out, args.checkpoint, trigger=_trigger(args)).awaitTermination()
    elif args.command == "latest":
        trades = to_trades(to_bronze(_topic(spark, args, args.topic)), keep=("source_ts",))
        if args.ttl:
            start_live_prices(trades, args.out, args.checkpoint, args.ttl, trigger=_trigger(args)).awaitTermination()
        else:
            start_latest_price(trades, args.out, args.checkpoint, trigger=_trigger(args)).awaitTermination()
    elif args.command == "volume":
        trades = to_trades(to_bronze(_topic(spark, args, args.topic)), keep=("source_ts",))
        start_live_volume(trades, args.out, args.checkpoint, args.window, trigger=_trigger(args)).awaitTermination()
    elif args.command == "enrich":
        both = to_bronze(_topic(spark, args, f"{args.topic},{args.quotes_topic}"))
        start_enrichment(
            both, args.out, args.quotes, args.checkpoint, trades_topic=args.topic, quotes_topic=args.quotes_topic,
            within=args.within, trigger=_trigger(args),
        ).awaitTermination()
    elif args.command == "compact":
        compact_bars(spark, args.out, args.month)
    elif args.command == "silver":
        jobs.bronze_to_silver(spark, _bronze(spark, args.bronze), args.silver, mode=args.mode, root=args.root,
                              since=args.since, rejects=args.rejects or f"{args.silver}_rejects")
    elif args.command == "gold":
        jobs.build_and_check_gold(spark, args.silver, args.gold, root=args.root, since=args.since)
    else:
        jobs.run_daily(spark, _bronze(spark, args.bronze), args.silver, args.gold, day=args.day, mode=args.mode,
                       root=args.root, since=args.since, rejects=args.rejects or f"{args.silver}_rejects")
