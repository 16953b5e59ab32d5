"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.operators import bars, enrich, gold, hot, marts, quality, silver
from tapeworks.plans import fixtures as fx
from tapeworks.plans import jobs
from tapeworks.plans.replay import replay_in_order, replay_shuffled
from tapeworks.schemas import BRONZE, HOT_TRADE, TRADE_CONTRACT
from tapeworks.session import prepare, workspace
from tapeworks.sinks import files
from tapeworks.sinks.tables import append_table, build_model, replace_table, scan
from tapeworks.sources.envelope import to_bronze
from tapeworks.streaming import runs
from tapeworks.streaming.bars import closed_bars, read_bars, start_bars
from tapeworks.streaming.dedupe import drop_repeats
from tapeworks.streaming.dual_sink import start_dual_sink
from tapeworks.streaming.enrichment import start_enrichment, with_late_quotes
from tapeworks.streaming.latest import read_latest, start_latest_price
from tapeworks.streaming.live import read_live_prices, read_live_volume, start_live_prices, start_live_volume

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Parameters of single queries; the oracle SQL names the same values.
INCREMENT_SINCE = datetime(1998, 6, 30, 17, 0)
RUN_DAY = date(1999, 3, 31)
CUT_OFF_DAY = date(2024, 1, 15)
PRUNE_DAYS = (date(2024, 1, 10), date(2024, 1, 12))
# Day by day, so that a run with no run the day before it is among them.
RUN_DAYS = (date(1998, 6, 30), date(1998, 7, 20), date(1999, 3, 31))
FRESH_WITHIN = "7 days"
RANGE_BOUNDS = ("1996-01-01", "2001-01-01")

# A SQL model of Gold, as analysts keep them: sums in decimals, for this engine's own SQL.
GOLD_MODEL = """
with parts as (
  select coalesce(to_date(source_ts), to_date(ingestion_time)) as trade_date, symbol, side,
         cast(quantity as decimal(18,4)) as qty, cast(price * quantity as decimal(18,4)) as notional
  from {silver} where coalesce(source_ts, ingestion_time) is not null
), sums as (
  select trade_date, symbol, count(*) as trades,
         cast(sum(if(side = 'buy', qty, 0)) as double) as buy_qty, cast(sum(if(side = 'sell', qty, 0)) as double) as sell_qty,
         cast(sum(if(side = 'buy', notional, 0)) as double) as buy_notional,
         cast(sum(if(side = 'sell', notional, 0)) as double) as sell_notional
  from parts group by trade_date, symbol
)
select trade_date, symbol, trades, buy_qty, sell_qty, buy_qty - sell_qty as net_qty, buy_notional, sell_notional,
       buy_notional + sell_notional as gross_notional,
       case when buy_qty > 0 then buy_notional / buy_qty end as avg_buy_price,
       case when sell_qty > 0 then sell_notional / sell_qty end as avg_sell_price
from sums"""


def _for_comparison(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the oracle has them."""
    return df.select(*[
        F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = lambda spark, sf_dir: _for_comparison(fn(prepare(spark), sf_dir))
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _fresh_name(base: str) -> str:
    return f"{base}_{uuid.uuid4().hex[:12]}"


# --- scans, sources, sinks -------------------------------------------------------------------------------

@query
def bronze_envelope(spark, sf_dir):
    return to_bronze(fx.trades_envelope(spark, sf_dir)).drop("ingestion_time")


@query
def bronze_scan(spark, sf_dir):
    name = _fresh_name("bronze_trades")
    append_table(fx.events_bronze(spark, sf_dir), name, workspace(spark, "bronze-scan"))
    return scan(spark, name).select(BRONZE.fieldNames())


@query
def bronze_append(spark, sf_dir):
    name = _fresh_name("bronze_events")
    root = workspace(spark, "bronze-append")
    append_table(to_bronze(fx.trades_envelope(spark, sf_dir)), name, root)
    append_table(to_bronze(fx.quotes_envelope(spark, sf_dir)), name, root)
    return scan(spark, name).select("kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "source_ts")


@query
def silver_replace(spark, sf_dir):
    name, root = _fresh_name("silver_trades"), workspace(spark, "silver-replace")
    replace_table(fx.parsed_trades(spark, sf_dir).select(*fx.SILVER.fieldNames(), *silver.LINEAGE), name, root)
    cleaned = silver.keep_newest(silver.clean(scan(spark, name))).select(fx.SILVER.fieldNames())
    replace_table(cleaned, name, root, {"layer": "silver"})
    return scan(spark, name)


@query
def gold_table_build(spark, sf_dir):
    name, view, root = _fresh_name("gold_daily"), _fresh_name("silver_view"), workspace(spark, "gold-table")
    fx.silver_trades(spark, sf_dir).createOrReplaceTempView(view)
    build_model(spark, name, GOLD_MODEL.format(silver=view), root)
    return scan(spark, name)


@query
def hot_layout(spark, sf_dir):
    path = workspace(spark, "hot-layout")
    files.write_by_month(hot.to_hot(fx.events_bronze(spark, sf_dir)), path, "trade_ts")
    return spark.read.parquet(path)


@query
def bars_layout(spark, sf_dir):
    path = workspace(spark, "bars-layout")
    files.write_by_month(bars.ohlcv(fx.event_trades(spark, sf_dir)), path, "minute")
    return spark.read.parquet(path)


@query
def bronze_partition_prune(spark, sf_dir):
    path = workspace(spark, "bronze-days")
    files.write_bronze(fx.events_bronze(spark, sf_dir), path)
    days = spark.read.parquet(path).filter(F.col("ingest_date").between(*[F.lit(d) for d in PRUNE_DAYS]))
    return days.select("kafka_partition", "kafka_offset", "source_ts", "ingest_date")


@query
def quotes_parse(spark, sf_dir):
    return hot.to_quotes(to_bronze(fx.quotes_envelope(spark, sf_dir)))


@query
def enriched_payload(spark, sf_dir):
    path = workspace(spark, "enriched-topic")
    enriched = _enriched(spark, sf_dir)
    enrich.to_payload(enriched).write.parquet(path)
    sent = spark.read.schema("key string, value string").parquet(path)
    return sent.select("key", F.inline(F.array(F.from_json("value", enriched.schema))))


@query
def contract_violations(spark, sf_dir):
    return quality.contract_violations(fx.untidy_bronze(spark, sf_dir), TRADE_CONTRACT)


# --- parsing and cleaning --------------------------------------------------------------------------------

@query
def hot_parse(spark, sf_dir):
    return hot.to_hot(to_bronze(fx.trades_envelope(spark, sf_dir)))


@query
def json_edge_cases(spark, sf_dir):
    parsed = silver.parse_trades(fx.untidy_bronze(spark, sf_dir))
    price = F.col("price")
    return parsed.select(
        *silver.LINEAGE, "trade_id", "symbol", "side",
        F.when(~F.isnan(price), price).alias("price"),
        F.coalesce(F.isnan(price), F.lit(False)).alias("price_is_nan"),
        "quantity", "trade_ts",
        F.array_join(silver.reject_reasons(parsed), ",").alias("reasons"),
    )


@query
def silver_parse(spark, sf_dir):
    return silver.parse_trades(fx.events_bronze(spark, sf_dir))


@query
def silver_required(spark, sf_dir):
    return silver.require_fields(fx.parsed_trades(spark, sf_dir))


@query
def silver_standardize(spark, sf_dir):
    return silver.standardize(fx.parsed_trades(spark, sf_dir))


@query
def silver_side_filter(spark, sf_dir):
    return silver.valid_sides(silver.standardize(fx.parsed_trades(spark, sf_dir)))


@query
def silver_dedupe(spark, sf_dir):
    return silver.keep_newest(silver.clean(fx.parsed_trades(spark, sf_dir)))


@query
def silver_rejects(spark, sf_dir):
    lost = silver.rejects(fx.cold_bronze(spark, sf_dir), workspace(spark, "parsed-records"))
    return lost.withColumn("reasons", F.array_join("reasons", ","))


# --- Gold ------------------------------------------------------------------------------------------------

@query
def gold_base(spark, sf_dir):
    return gold.gold_base(fx.silver_with_gaps(spark, sf_dir))


@query
def daily_trade_metrics(spark, sf_dir):
    return gold.daily_trade_metrics(fx.silver_trades(spark, sf_dir)).drop("ingested_at")


@query
def daily_qty(spark, sf_dir):
    metrics = gold.daily_trade_metrics(fx.silver_with_gaps(spark, sf_dir))
    return metrics.select("trade_date", "symbol", "trades", "buy_qty", "sell_qty", "net_qty")


@query
def daily_notional(spark, sf_dir):
    metrics = gold.daily_trade_metrics(fx.silver_with_gaps(spark, sf_dir))
    return metrics.select("trade_date", "symbol", "buy_notional", "sell_notional", "gross_notional")


@query
def daily_fees(spark, sf_dir):
    return gold.daily_fees(fx.silver_with_gaps(spark, sf_dir))


@query
def daily_vwap(spark, sf_dir):
    metrics = gold.daily_trade_metrics(fx.silver_with_gaps(spark, sf_dir))
    return metrics.select("trade_date", "symbol", "avg_buy_price", "avg_sell_price")


# --- joins -----------------------------------------------------------------------------------------------

def _enriched(spark, sf_dir):
    return enrich.with_quotes(fx.event_trades(spark, sf_dir), fx.event_quotes(spark, sf_dir))


@query
def trades_enriched(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query
def silver_incremental(spark, sf_dir):
    name, root = _fresh_name("silver_trades"), workspace(spark, "silver-incremental")
    bronze = fx.cold_bronze(spark, sf_dir)
    jobs.bronze_to_silver(spark, bronze, name, root=root, as_of=INCREMENT_SINCE)
    jobs.bronze_to_silver(spark, bronze, name, mode="incremental", root=root, since=INCREMENT_SINCE)
    return scan(spark, name)


# --- bars ------------------------------------------------------------------------------------------------

@query
def ohlcv_1m(spark, sf_dir):
    return bars.ohlcv(fx.event_trades(spark, sf_dir))


@query
def open_close(spark, sf_dir):
    return bars.open_close(fx.event_trades(spark, sf_dir))


@query
def high_low_volume(spark, sf_dir):
    return bars.high_low_volume(fx.event_trades(spark, sf_dir))


@query
def bars_merge(spark, sf_dir):
    parts = bars.partial_bars(fx.event_trades(spark, sf_dir), "10 seconds")
    return bars.merge_bars(parts, "1 minute").select(bars.BAR_COLUMNS)


@query
def ohlcv_rollup(spark, sf_dir):
    minutes = bars.partial_bars(fx.event_trades(spark, sf_dir))
    hours = bars.merge_bars(minutes, "1 hour")
    days = bars.merge_bars(hours, "1 day")
    return hours.select(F.lit("1 hour").alias("width"), *bars.BAR_COLUMNS).unionByName(
        days.select(F.lit("1 day").alias("width"), *bars.BAR_COLUMNS)
    )


# --- quality ---------------------------------------------------------------------------------------------

@query
def stage_counts(spark, sf_dir):
    return quality.stage_counts(silver.flagged(fx.cold_bronze(spark, sf_dir)))


@query
def quality_not_null(spark, sf_dir):
    metrics = gold.daily_trade_metrics(fx.silver_trades(spark, sf_dir))
    return quality.check(metrics, quality.not_null("trade_date", "symbol", "avg_buy_price"))


@query
def quality_required(spark, sf_dir):
    return quality.check(fx.parsed_trades(spark, sf_dir), quality.required(*silver.REQUIRED))


@query
def quality_accepted_values(spark, sf_dir):
    tidy = silver.standardize(fx.parsed_trades(spark, sf_dir))
    return quality.check(tidy, [quality.accepted_values("side", silver.SIDES)])


@query
def quality_unique(spark, sf_dir):
    return quality.check_unique(silver.clean(fx.parsed_trades(spark, sf_dir)), "trade_id")


@query
def quality_ranges(spark, sf_dir):
    on_trades = quality.check(fx.silver_trades(spark, sf_dir), quality.trade_ranges(*RANGE_BOUNDS))
    on_quotes = quality.check(fx.event_quotes(spark, sf_dir), quality.quote_ranges())
    fresh = quality.check_fresh(fx.silver_trades(spark, sf_dir), "symbol", "trade_ts", FRESH_WITHIN)
    return on_trades.unionByName(on_quotes).unionByName(fresh)


@query
def stale_symbols(spark, sf_dir):
    return quality.stale(fx.silver_trades(spark, sf_dir), "symbol", "trade_ts", FRESH_WITHIN)


@query
def missing_offsets(spark, sf_dir):
    return quality.missing_offsets(fx.lossy_bronze(spark, sf_dir), at_once=1000)


@query
def schema_profile(spark, sf_dir):
    return quality.schema_profile(fx.untidy_bronze(spark, sf_dir), TRADE_CONTRACT)


# --- marts -----------------------------------------------------------------------------------------------

@query
def latest_price(spark, sf_dir):
    return marts.latest_price(fx.live_trades(spark, sf_dir))


@query
def live_volume(spark, sf_dir):
    return marts.live_volume(fx.live_trades(spark, sf_dir))


@query
def active_positions(spark, sf_dir):
    return marts.active_positions(fx.silver_trades(spark, sf_dir))


@query
def daily_pnl(spark, sf_dir):
    return marts.daily_pnl(fx.silver_trades(spark, sf_dir))


@query
def portfolio_summary(spark, sf_dir):
    return marts.portfolio_summary(fx.silver_trades(spark, sf_dir))


@query
def risk_metrics(spark, sf_dir):
    return marts.risk_metrics(fx.silver_trades(spark, sf_dir))


@query
def quote_bars(spark, sf_dir):
    return marts.quote_bars(fx.event_quotes(spark, sf_dir))


# --- jobs ------------------------------------------------------------------------------------------------

@query
def silver_trades(spark, sf_dir):
    name, root = _fresh_name("silver_trades"), workspace(spark, "silver-job")
    jobs.bronze_to_silver(spark, fx.cold_bronze(spark, sf_dir), name, root=root)
    return scan(spark, name)


@query
def gold_build_and_check(spark, sf_dir):
    clean, daily = _fresh_name("silver_trades"), _fresh_name("gold_daily")
    root = workspace(spark, "gold-job")
    replace_table(fx.silver_with_gaps(spark, sf_dir), clean, root)
    return jobs.build_and_check_gold(spark, clean, daily, root=root)


@query
def run_daily(spark, sf_dir):
    clean, daily = _fresh_name("silver_trades"), _fresh_name("gold_daily")
    jobs.run_daily(spark, fx.cold_bronze(spark, sf_dir), clean, daily, day=RUN_DAY,
                   root=workspace(spark, "daily-job"))
    return scan(spark, daily).drop("ingested_at", "trade_month")


@query
def run_daily_incremental(spark, sf_dir):
    clean, daily, root = _fresh_name("silver_trades"), _fresh_name("gold_daily"), workspace(spark, "daily-increments")
    for day in RUN_DAYS:
        jobs.run_daily(spark, fx.cold_bronze(spark, sf_dir), clean, daily, day=day, mode="incremental", root=root)
    return scan(spark, daily).drop("ingested_at", "trade_month")


@query
def changed_trades(spark, sf_dir):
    clean, lost, root = _fresh_name("silver_trades"), _fresh_name("rejects"), workspace(spark, "changed-trades")
    for day in RUN_DAYS:
        jobs.bronze_to_silver(spark, fx.cold_bronze(spark, sf_dir), clean, mode="incremental", root=root,
                              as_of=jobs.cut_off(day), rejects=lost)
    return scan(spark, lost).filter("reasons = 'changed_trade'").select("trade_id", *silver.LINEAGE, "period")


@query
def gold_reconciled(spark, sf_dir):
    trades = files.staged(fx.silver_with_gaps(spark, sf_dir), workspace(spark, "reconciled"))
    return quality.reconciled(trades, gold.daily_trade_metrics(trades))


@query
def asof_cutoff(spark, sf_dir):
    in_time = jobs.arrived(fx.events_bronze(spark, sf_dir), as_of=jobs.cut_off(CUT_OFF_DAY))
    return in_time.select("kafka_partition", "kafka_offset", "ingestion_time")


# --- streams ---------------------------------------------------------------------------------------------

@query
def stream_ingest(spark, sf_dir):
    path, checkpoint = workspace(spark, "ingested"), workspace(spark, "checkpoint")
    replay_shuffled(
        fx.trades_envelope(spark, sf_dir),
        lambda stream: runs.start_files(to_bronze(stream), path, checkpoint, runs.CATCH_UP),
    )
    return spark.read.schema(BRONZE).parquet(path).drop("ingestion_time")


@query
def stream_restart(spark, sf_dir):
    path, checkpoint = workspace(spark, "restarted"), workspace(spark, "checkpoint")
    write = files.bronze_batch_writer(path)
    replay_in_order(
        fx.trades_envelope(spark, sf_dir),
        lambda stream: runs.start_batches(to_bronze(stream), write, checkpoint, runs.CATCH_UP),
    )
    return spark.read.parquet(path).select(*[c for c in BRONZE.fieldNames() if c != "ingestion_time"])


def _dual_sink(spark, sf_dir):
    bronze, hot_path, checkpoint = (workspace(spark, p) for p in ("bronze", "hot", "checkpoint"))
    replay_shuffled(
        fx.trades_envelope(spark, sf_dir),
        lambda stream: start_dual_sink(
            stream, files.bronze_batch_writer(bronze), files.month_batch_writer(hot_path, "trade_ts"),
            checkpoint, runs.CATCH_UP,
        ),
    )
    return bronze, hot_path


@query
def dual_sink_bronze(spark, sf_dir):
    bronze, _ = _dual_sink(spark, sf_dir)
    return spark.read.parquet(bronze).select(*[c for c in BRONZE.fieldNames() if c != "ingestion_time"])


@query
def dual_sink_hot(spark, sf_dir):
    _, hot_path = _dual_sink(spark, sf_dir)
    return spark.read.parquet(hot_path).select(HOT_TRADE.fieldNames())


@query
def dual_sink_rejects(spark, sf_dir):
    bronze, hot_path, rejects, checkpoint = (workspace(spark, p) for p in ("bronze", "hot", "rejects", "checkpoint"))
    replay_shuffled(
        fx.untidy_envelope(spark, sf_dir),
        lambda stream: start_dual_sink(
            stream, files.bronze_batch_writer(bronze), files.month_batch_writer(hot_path, "trade_ts"), checkpoint,
            runs.CATCH_UP, write_rejects=lambda df, batch_id: files.write_batch(df, rejects, batch_id),
        ),
    )
    return spark.read.parquet(rejects).select(*silver.LINEAGE, "reasons")


@query
def ohlcv_stream(spark, sf_dir):
    path, checkpoint = workspace(spark, "stream-bars"), workspace(spark, "checkpoint")
    replay_shuffled(
        fx.trades_envelope(spark, sf_dir),
        lambda stream: start_bars(hot.to_trades(stream, "value"), path, checkpoint, trigger=runs.CATCH_UP),
    )
    return read_bars(spark, path)


@query
def ohlcv_late_repair(spark, sf_dir):
    path, checkpoint = workspace(spark, "closed-bars"), workspace(spark, "checkpoint")
    envelope = fx.trades_envelope(spark, sf_dir)
    replay_shuffled(
        envelope,
        lambda stream: runs.start_files(
            closed_bars(hot.to_trades(stream, "value"), "1 hour"), path, checkpoint, runs.CATCH_UP
        ),
        batches=2,
    )
    trades = files.staged(hot.to_trades(to_bronze(envelope)), workspace(spark, "parsed-trades"))
    return bars.repair_bars(spark.read.parquet(path), trades)


@query
def stream_dedupe(spark, sf_dir):
    path, checkpoint = workspace(spark, "deduped"), workspace(spark, "checkpoint")
    # The fixture is in no order of time and spans years, so the watermark has to wait as long.
    # No more than the columns that tell repeats go on; Spark does not look through a Python step for that.
    asked = ("trade_id", "trade_ts", *silver.LINEAGE)
    replay_shuffled(
        fx.lineitem_envelope(spark, sf_dir),
        lambda stream: runs.start_files(
            drop_repeats(hot.to_trades(to_bronze(stream), keep=silver.LINEAGE).select(*asked), "3650 days").select("trade_id"),
            path, checkpoint, runs.CATCH_UP,
        ),
        batches=2,
    )
    return spark.read.parquet(path)


@query
def latest_price_stream(spark, sf_dir):
    path, checkpoint = workspace(spark, "latest"), workspace(spark, "checkpoint")
    replay_shuffled(
        fx.live_envelope(spark, sf_dir),
        lambda stream: start_latest_price(
            hot.to_trades(to_bronze(stream), keep=("source_ts",)), path, checkpoint, trigger=runs.CATCH_UP
        ),
    )
    return read_latest(spark, path)


@query
def latest_price_expiring(spark, sf_dir):
    path, checkpoint = workspace(spark, "live-prices"), workspace(spark, "checkpoint")
    replay_in_order(
        fx.live_envelope(spark, sf_dir),
        lambda stream: start_live_prices(
            hot.to_trades(to_bronze(stream), keep=("source_ts",)), path, checkpoint, trigger=runs.CATCH_UP
        ),
    )
    return read_live_prices(spark, path)


@query
def live_volume_stream(spark, sf_dir):
    path, checkpoint = workspace(spark, "live-volume"), workspace(spark, "checkpoint")
    replay_shuffled(
        fx.live_envelope(spark, sf_dir),
        lambda stream: start_live_volume(
            hot.to_trades(to_bronze(stream), keep=("source_ts",)), path, checkpoint, trigger=runs.CATCH_UP
        ),
    )
    return read_live_volume(spark, path)


@query
def trades_enriched_stream(spark, sf_dir):
    path, quotes, checkpoint = (workspace(spark, p) for p in ("enriched", "quotes", "checkpoint"))
    both = fx.trades_envelope(spark, sf_dir).unionByName(fx.quotes_envelope(spark, sf_dir))
    replay_in_order(
        both,
        lambda stream: start_enrichment(
            to_bronze(stream), path, quotes, checkpoint, within="1 day", trigger=runs.CATCH_UP
        ),
    )
    return spark.read.parquet(path).drop("batch_id")


@query
def trades_enriched_late(spark, sf_dir):
    path, checkpoint = workspace(spark, "enriched-late"), workspace(spark, "checkpoint")
    replay_in_order(
        fx.late_quotes_envelope(spark, sf_dir),
        lambda stream: runs.start_files(
            with_late_quotes(to_bronze(stream), "400 days", within="1 day"), path, checkpoint, runs.CATCH_UP
        ),
    )
    return spark.read.parquet(path).drop(*silver.LINEAGE)
