"""Trades and quotes derived from the given test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.operators.silver import LINEAGE, clean, keep_newest
from tapeworks.schemas import HOT_TRADE, SILVER
from tapeworks.sources.envelope import to_bronze

TRADES_TOPIC = "trades_raw"
QUOTES_TOPIC = "market_data_raw"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _utc(column: str) -> Column:
    return F.col(column).cast("timestamp")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


# --- cold path: lineitem, with repeated trades, missing symbols, untidy and unknown sides -----------------

def parsed_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as Bronze parsing would give them."""
    returned, status = F.col("l_returnflag"), F.col("l_linestatus")
    side = (
        F.when(returned == "A", "BUY").when(returned == "R", " sell ").when(status == "O", "Buy").otherwise("HOLD")
    )
    shipped = _utc("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(_text("l_orderkey"), F.lit("-"), _text("l_linenumber")).alias("trade_id"),
        F.when(F.col("l_partkey") % 97 != 0, F.concat(F.lit(" SYM"), _text("l_suppkey"), F.lit(" "))).alias("symbol"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        side.alias("side"),
        shipped.alias("trade_ts"),
        shipped.alias("source_ts"),
        (shipped + F.expr("interval 1 hour")).alias("ingestion_time"),
        (F.col("l_suppkey") % 3).cast("int").alias("kafka_partition"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("kafka_offset"),
    )


def silver_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trades, one per id."""
    return keep_newest(clean(parsed_trades(spark, sf_dir))).select(SILVER.fieldNames())


def silver_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trades of which some have no broker time, and some no time at all."""
    gap = F.col("kafka_offset") % 89
    silver = keep_newest(clean(parsed_trades(spark, sf_dir)))
    return silver.withColumns({
        "source_ts": F.when(gap > 1, F.col("source_ts")),
        "ingestion_time": F.when(gap != 1, F.col("ingestion_time")),
    }).select(SILVER.fieldNames())


def _payload(trades: DataFrame) -> Column:
    fields = [F.col(f) for f in HOT_TRADE.fieldNames() if f != "trade_ts"]
    return F.to_json(F.struct(*fields, F.unix_millis("trade_ts").alias("trade_ts")))


def cold_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trades as raw Bronze records."""
    trades = parsed_trades(spark, sf_dir)
    return trades.select(
        F.col("trade_id").alias("kafka_key"),
        _payload(trades).alias("raw_value"),
        F.lit(TRADES_TOPIC).alias("kafka_topic"),
        *LINEAGE,
        "source_ts",
        "ingestion_time",
    )


# --- hot path: events ------------------------------------------------------------------------------------

def _event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    side = (
        F.when(kind == "purchase", "BUY").when(kind == "view", " sell ").when(kind == "click", "Buy")
        .when(kind == "signup", "SELL").otherwise("HOLD")
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("t"), _text("event_id")).alias("trade_id"),
        F.concat(F.lit("SYM"), (F.col("user_id") % 20).cast("string")).alias("symbol"),
        side.alias("side"),
        F.col("value").alias("price"),
        (F.col("event_id") % 100 + 1).cast("double").alias("quantity"),
        F.date_trunc("millisecond", _utc("ts")).alias("trade_ts"),
        "event_id", "event_type", "user_id", _utc("ts").alias("ts"),
    )


def event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades with millisecond times."""
    return _event_trades(spark, sf_dir).select(HOT_TRADE.fieldNames())


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event trades of which a few say that they happened ten years later."""
    wrong = F.col("event_id") % 997 == 3
    later = F.when(wrong, F.col("trade_ts") + F.expr("interval 10 years")).otherwise(F.col("trade_ts"))
    return _event_trades(spark, sf_dir).withColumn("trade_ts", later)


def live_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those trades with the broker's time beside their own."""
    return _live(spark, sf_dir).withColumn("source_ts", F.col("ts")).select(*HOT_TRADE.fieldNames(), "source_ts")


def live_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _live(spark, sf_dir)
    return _envelope(rows, TRADES_TOPIC, _payload(rows))


def _envelope(rows: DataFrame, topic: str, value: Column) -> DataFrame:
    return rows.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 3).alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def trades_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records of the trades."""
    rows = _event_trades(spark, sf_dir)
    return _envelope(rows, TRADES_TOPIC, _payload(rows))


def events_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze records of the event trades, ingested a minute after they happened."""
    bronze = to_bronze(trades_envelope(spark, sf_dir))
    return bronze.withColumn("ingestion_time", F.col("source_ts") + F.expr("interval 1 minute"))


def lossy_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those records, some stretches of offsets lost, and some records twice."""
    bronze, place = events_bronze(spark, sf_dir), F.col("kafka_offset") + 17 * F.col("kafka_partition")
    kept = bronze.filter((F.floor(place / 7) % 13 != 5) & (F.floor(place / 900) % 5 != 2))
    return kept.unionByName(kept.filter(place % 31 == 1))


def lineitem_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records with repeated trades."""
    bronze = cold_bronze(spark, sf_dir)
    return bronze.select(
        F.col("kafka_key").cast("binary").alias("key"), F.col("raw_value").cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"), F.col("source_ts").alias("timestamp"),
    )


def _event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _event_trades(spark, sf_dir).filter(F.col("event_type") == "view")
    ask = F.col("price") + F.lit(0.01) * (F.col("event_id") % 50 + 1)
    return rows.select("symbol", F.col("price").alias("bid"), ask.alias("ask"), F.col("trade_ts").alias("event_ts"),
                       "event_id", "user_id", "ts")


def event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_quotes(spark, sf_dir).select("symbol", "bid", "ask", "event_ts")


def quotes_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _event_quotes(spark, sf_dir)
    value = F.to_json(F.struct("symbol", "bid", "ask", F.unix_millis("event_ts").alias("event_ts")))
    return _envelope(rows, QUOTES_TOPIC, value)


def late_quotes_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades, and quotes that the broker gets ten days late; then one of each, years later, which ends all waiting."""
    late = quotes_envelope(spark, sf_dir).withColumn("timestamp", F.col("timestamp") + F.expr("interval 10 days"))
    both = trades_envelope(spark, sf_dir).unionByName(late)
    end = both.agg(F.max("timestamp").alias("timestamp"))
    years = F.unix_millis(F.col("timestamp") + F.expr("interval 10 years"))
    last = {TRADES_TOPIC: F.struct(F.lit("end").alias("trade_id"), years.alias("trade_ts")),
            QUOTES_TOPIC: F.struct(F.lit("end").alias("symbol"), years.alias("event_ts"))}
    for topic, value in last.items():
        row = end.select(F.lit(None).cast("binary").alias("key"), F.to_json(value).cast("binary").alias("value"),
                         F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.lit(-1).cast("long").alias("offset"), "timestamp")
        both = both.unionByName(row)
    return both


def untidy_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(untidy_envelope(spark, sf_dir))


def untidy_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a record in one of seventeen well or badly formed ways, by its number."""
    rows = _event_trades(spark, sf_dir)
    name = F.col("trade_id")
    millis = F.unix_millis("trade_ts").cast("string")

    def text(trade_id='"trade_id":"{id}"', symbol='"symbol":"SYM"', side='"side":"BUY"', price='"price":{price}',
             when='"trade_ts":{ms}', end="}"):
        body = "{" + ",".join([trade_id, symbol, side, price, '"quantity":2.5', when]) + end
        parts = []
        for piece in body.replace("{id}", "\0i\0").replace("{price}", "\0p\0").replace("{ms}", "\0m\0").split("\0"):
            parts.append({"i": name, "p": F.col("price").cast("string"), "m": millis}.get(piece, F.lit(piece)))
        return F.concat(*parts)

    forms = [
        text(),
        F.lit("{not json"),
        text(end=""),
        F.lit(""),
        F.lit(None).cast("string"),
        F.concat(F.lit("["), text(), F.lit(',{"trade_id":"second"}]')),
        text(price='"price":"{price}"'),
        text(trade_id='"trade_id":5'),
        text(price='"price":NaN'),
        text(trade_id='"TRADE_ID":"{id}"'),
        text(price='"price":{price},"zzz":1'),
        text(symbol='"symbol":"  "'),
        text(side='"side":"\\tbuy"'),
        text(when='"trade_ts":-1500'),
        text(when='"timestamp":"2024-03-01T10:20:30.250Z"'),
        text(symbol='"symbol":{"name":"SYM"}'),
        text(side='"side":null'),
    ]
    form = F.col("event_id") % len(forms)
    value = F.when(form == 0, forms[0])
    for number, variant in enumerate(forms[1:], start=1):
        value = value.when(form == number, variant)
    return _envelope(rows, TRADES_TOPIC, value)
