"""Bronze to Silver: parse, require, standardise, keep one row per trade."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.payload import parse_payload
from tapeworks.functions.skew import HOT_ROWS, left_lookup
from tapeworks.functions.times import event_time
from tapeworks.schemas import SILVER, TRADE_PAYLOAD
from tapeworks.sinks.files import staged

REQUIRED = ("trade_id", "symbol", "side", "price", "quantity")
SIDES = ("buy", "sell")
# Where a record stood in its topic; the newest of several records wins.
LINEAGE = ("kafka_partition", "kafka_offset")
NEWEST = ("source_ts", *LINEAGE)


def parse_trades(bronze: DataFrame) -> DataFrame:
    """Silver columns from the raw payload, plus the lineage needed to pick the newest record."""
    parsed = parse_payload(bronze, TRADE_PAYLOAD, keep=["ingestion_time", *NEWEST])
    when = event_time(F.col("trade_ts"), F.col("timestamp"))
    return parsed.withColumn("trade_ts", when).select(*SILVER.fieldNames(), *LINEAGE)


def require_fields(trades: DataFrame, fields: Sequence[str] = REQUIRED) -> DataFrame:
    """Drop rows with NULL, or NaN in a number, in any required field."""
    return trades.dropna(subset=list(fields))


def clean_side(side: Column) -> Column:
    return F.lower(F.trim(side))


def standardize(trades: DataFrame) -> DataFrame:
    """Trim the symbol, trim and lower-case the side. Spaces only: a tab is part of the value."""
    return trades.withColumns({"symbol": F.trim("symbol"), "side": clean_side(F.col("side"))})


def valid_sides(trades: DataFrame) -> DataFrame:
    return trades.filter(F.col("side").isin(*SIDES))


def clean(trades: DataFrame) -> DataFrame:
    """Required fields are checked before trimming, so a blank symbol stays as an empty string."""
    return valid_sides(standardize(require_fields(trades)))


def keep_newest(df: DataFrame, key: str = "trade_id", order: Sequence[str] = NEWEST) -> DataFrame:
    """One row per key: the largest by ``order``; rows equal in all of it are copies of one broker record.

    Spark keeps the first row of each key already in every task before the shuffle (WindowGroupLimit), so a key
    that fills a third of the table costs no more than any other, and columns nobody reads later are pruned.
    """
    newest_first = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("place", F.row_number().over(newest_first)).filter("place = 1").drop("place")


def to_silver(bronze: DataFrame) -> DataFrame:
    """The whole Bronze to Silver step."""
    return keep_newest(clean(parse_trades(bronze))).select(SILVER.fieldNames())


# What a trade says, apart from when its record came; in Silver's own form.
CONTENT = ("symbol", "price", "quantity", "side", "trade_ts")


def content() -> Column:
    """A hash by which a record that repeats a trade is told from one that changes it."""
    return F.xxhash64(*CONTENT)


def against_known(batch: DataFrame, known: DataFrame, key: str = "trade_id") -> DataFrame:
    """batch with ``known``, the content that Silver holds under the same key, or NULL.

    ``known`` has one row for each key of the batch that Silver holds. Silver is not cut down to the batch's dates: a
    trade sent again on a later day must be found too. The few known keys are hashed; the batch is not sorted.
    """
    return batch.join(known.select(key, F.col("content").alias("known")).hint("shuffle_hash"), key, "left")


def _missing(field: str, kind: str) -> Column:
    value = F.col(field)
    return value.isNull() | F.isnan(value) if kind == "double" else value.isNull()


def reject_reasons(trades: DataFrame) -> Column:
    """Why a parsed row cannot enter Silver, as an array; empty for a good row."""
    types = dict(trades.dtypes)
    missing = {f: _missing(f, types[f]) for f in REQUIRED}
    nothing = F.lit(True)
    for f in REQUIRED:
        nothing = nothing & F.col(f).isNull()
    wrong_side = ~clean_side(F.col("side")).isin(*SIDES)
    reasons = [F.when(test, F.lit(f"missing_{f}")) for f, test in missing.items()]
    reasons.append(F.when(wrong_side, F.lit("invalid_side")))
    return F.when(nothing, F.array(F.lit("unparsable"))).otherwise(F.array_compact(F.array(*reasons)))


def flagged(bronze: DataFrame) -> DataFrame:
    """All parsed records with the reasons why they cannot enter Silver; the payload is read once."""
    parsed = parse_payload(bronze, TRADE_PAYLOAD, keep=["kafka_topic", "ingestion_time", *NEWEST])
    when = event_time(F.col("trade_ts"), F.col("timestamp"))
    timed = parsed.withColumn("trade_ts", when).select("kafka_topic", *SILVER.fieldNames(), *LINEAGE)
    return timed.withColumn("reasons", reject_reasons(timed))


def accepted(records: DataFrame) -> DataFrame:
    """The :func:`flagged` records without a reason, as Silver has them."""
    return standardize(records.filter(F.size("reasons") == 0)).drop("reasons")


_REJECT_COLUMNS = ("trade_id", "symbol", "side", "price", "quantity", *NEWEST)


def rejected(records: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The :func:`flagged` records that do not reach Silver, with the reasons. The records are used three times.

    Bad records are just filtered out. The newest record of every repeated trade comes from an aggregate that
    combines before its shuffle, and is looked up for the good records only. Exact re-deliveries of the winning
    record (same partition and offset) are the same record and are not listed.
    """
    good = records.filter(F.size("reasons") == 0).select(*_REJECT_COLUMNS)
    bad = records.filter(F.size("reasons") > 0).select(*_REJECT_COLUMNS, "reasons")
    place = F.struct(*NEWEST)
    repeated = (
        good.groupBy(F.col("trade_id").alias("match"))
        .agg(F.max(place).alias("winner"), F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )
    matched = left_lookup(good.withColumn("match", F.col("trade_id")), repeated, ["match"], "copies", hot_rows)
    winner = F.col("found.winner")
    lost = matched.filter(winner.isNotNull() & ~place.eqNullSafe(winner))
    return bad.unionByName(lost.select(*_REJECT_COLUMNS, F.array(F.lit("duplicate_trade_id")).alias("reasons")))


def rejects(bronze: DataFrame, stage: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every Bronze record that does not reach Silver, with the reasons.

    With a ``stage`` folder the parsed records are written there, and the raw payload is read and parsed only once.
    """
    records = flagged(bronze).select(*_REJECT_COLUMNS, "reasons")
    return rejected(staged(records, stage) if stage is not None else records, hot_rows)
