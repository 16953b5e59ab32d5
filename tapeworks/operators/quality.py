"""Quality rules, stage counts and payload profiles."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.operators.silver import LINEAGE
from tapeworks.schemas import Contract


class QualityError(RuntimeError):
    """Some rule with severity error has failing rows."""


@dataclass(frozen=True)
class Rule:
    """A named test of one row; ``failing`` is true where the row breaks it."""

    name: str
    failing: Column


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"not_null_{c}", F.col(c).isNull()) for c in columns]


def required(*columns: str, numbers: Iterable[str] = ("price", "quantity")) -> list[Rule]:
    """No NULL; for numbers also no NaN."""
    numbers = set(numbers)
    return [
        Rule(f"required_{c}", F.col(c).isNull() | F.isnan(c) if c in numbers else F.col(c).isNull())
        for c in columns
    ]


def accepted_values(column: str, values: Sequence[str]) -> Rule:
    """Only the given values; NULL is the business of :func:`not_null`."""
    return Rule(f"accepted_values_{column}", ~F.col(column).isin(*values))


def trade_ranges(earliest: str, latest: str) -> list[Rule]:
    """Plausible Silver rows; what is NULL or NaN is not plausible."""
    bounds = F.col("trade_ts").between(F.lit(earliest).cast("timestamp"), F.lit(latest).cast("timestamp"))
    return [
        Rule("price_positive", ~_holds((F.col("price") > 0) & ~F.isnan("price"))),
        Rule("quantity_positive", ~_holds((F.col("quantity") > 0) & ~F.isnan("quantity"))),
        Rule("symbol_not_blank", ~_holds(F.trim("symbol") != "")),
        Rule("event_time_in_bounds", ~_holds(bounds)),
    ]


def quote_ranges() -> list[Rule]:
    numbers = ~F.isnan("ask") & ~F.isnan("bid")
    return [Rule("ask_not_below_bid", ~_holds((F.col("ask") >= F.col("bid")) & numbers))]


def _holds(test: Column) -> Column:
    """A test that came out as NULL does not hold."""
    return F.coalesce(test, F.lit(False))


def _verdict(results: DataFrame) -> DataFrame:
    return results.withColumns({"should_warn": F.col("failures") != 0, "should_error": F.col("failures") != 0})


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One line per rule: failing rows and the verdict. All rules share one pass over the table."""
    counts = df.agg(*[F.count_if(r.failing).alias(f"r{i}") for i, r in enumerate(rules)])
    lines = [F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("failures")) for i, r in enumerate(rules)]
    return _verdict(counts.select(F.inline(F.array(*lines))))


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """How many key values occur more than once."""
    repeated = df.groupBy(key).count().filter((F.col("count") > 1) & F.col(key).isNotNull())
    return _verdict(repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(f"unique_{key}").alias("rule"), "failures"
    ))


def newest_by(df: DataFrame, key: str, ts: str) -> DataFrame:
    """(key, newest): the newest time of each key; rows without a time add their key, with no time of their own."""
    return df.groupBy(key).agg(F.max(ts).alias("newest"))


def stale(df: DataFrame, key: str, ts: str, within: str, now: datetime | None = None) -> DataFrame:
    """(key, newest) for every key whose newest time is older than ``within`` before now, or that has none.

    Now is the table's newest time unless given.
    """
    newest = newest_by(df, key, ts)
    clock = F.lit(now).cast("timestamp") if now is not None else newest.select(F.max("newest")).scalar()
    return newest.filter(~_holds(F.col("newest") >= clock - F.expr(f"interval {within}")))


def check_fresh(df: DataFrame, key: str, ts: str, within: str, now: datetime | None = None) -> DataFrame:
    """One line, a rule over the table: how many keys are :func:`stale`."""
    late = stale(df, key, ts, within, now).agg(F.count(F.lit(1)).alias("failures"))
    return _verdict(late.select(F.lit(f"fresh_{key}").alias("rule"), "failures"))


def raise_on_failure(results: DataFrame) -> None:
    """Stop the job when a rule failed. One line per rule reaches the driver."""
    failed = [f"{r.rule}: {r.failures} rows" for r in results.filter("should_error").collect()]
    if failed:
        raise QualityError("; ".join(failed))


_CORRUPT = "__corrupt"
# What values of a JSON text are to the engine, by the contract's type.
_KINDS = {T.StringType: "STRING", T.BooleanType: "BOOLEAN", T.LongType: "BIGINT", T.IntegerType: "BIGINT",
          T.DoubleType: "BIGINT|DOUBLE|FLOAT|DECIMAL.*", T.FloatType: "BIGINT|DOUBLE|FLOAT|DECIMAL.*"}


def contract_rules(contract: Contract, read: str = "read", kinds: str = "kinds") -> list[Rule]:
    """Rules for a payload whose fields are read as they come, and for the JSON type of each field.

    A JSON null counts as missing, as a field that is not there does.
    """
    broken = F.col(read).isNull() | F.col(read)[_CORRUPT].isNotNull()
    rules = [Rule("payload:unparsable", broken)]
    for f in contract.fields:
        kind = F.col(kinds)[f.name]
        if not f.nullable:
            rules.append(Rule(f"{f.name}:missing", ~broken & kind.isNull()))
        fits = kind.rlike(f"^({_KINDS.get(type(f.spark_type), '.*')})$")
        if isinstance(f.spark_type, T.IntegerType):
            fits = fits & F.try_variant_get(F.col(read)[f.name], "$", "int").isNotNull()
        rules.append(Rule(f"{f.name}:wrong_type", ~broken & kind.isNotNull() & ~fits))
        if f.symbols:
            # Of a field of another type the text is looked at.
            value = F.coalesce(F.try_variant_get(F.col(read)[f.name], "$", "string"), F.to_json(F.col(read)[f.name]))
            rules.append(Rule(f"{f.name}:not_in_enum", ~broken & kind.isNotNull() & ~value.isin(*f.symbols)))
    return rules


def contract_violations(bronze: DataFrame, contract: Contract, value: str = "raw_value") -> DataFrame:
    """Violations of a contract, per field and kind, in one reading of the raw payload.

    Each field of the contract is read as a VARIANT, which keeps its type; the parser runs once for a record.
    """
    schema = T.StructType([*(T.StructField(f.name, T.VariantType()) for f in contract.fields),
                           T.StructField(_CORRUPT, T.StringType())])
    read = bronze.select(F.inline(F.array(F.struct(
        F.from_json(value, schema, {"columnNameOfCorruptRecord": _CORRUPT}).alias("read")))))
    kinds = F.struct(*[F.nullif(F.schema_of_variant(F.col("read")[f.name]), F.lit("VOID")).alias(f.name) for f in contract.fields])
    return check(read.select("read", F.inline(F.array(F.struct(kinds.alias("kinds"))))), contract_rules(contract))


def schema_profile(bronze: DataFrame, contract: Contract, value: str = "raw_value") -> DataFrame:
    """Every JSON key seen, its rows and NULLs, and whether the contract knows it.

    Contract keys nobody sent appear with zero rows; a key that was renamed at the source shows up as one
    known key without rows and one unknown key with all of them.
    """
    entries = bronze.select(F.explode(F.from_json(value, T.MapType(T.StringType(), T.StringType()))))
    seen = entries.select("key", F.lit(1).alias("rows"), F.col("value").isNull().cast("int").alias("nulls"))
    names = F.array(*[F.lit(f.name) for f in contract.fields])
    known = bronze.sparkSession.range(1).select(
        F.explode(names).alias("key"), F.lit(0).alias("rows"), F.lit(0).alias("nulls")
    )
    return seen.unionByName(known).groupBy("key").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls")
    ).withColumn("in_contract", F.col("key").isin(*[f.name for f in contract.fields]))


def stage_counts(records: DataFrame) -> DataFrame:
    """What became of the records that :func:`~tapeworks.operators.silver.flagged` gives; the columns add up.

    Bronze rows are rejected or clean; clean ones are re-deliveries of the same broker record, duplicates of a trade
    with another record, or rows of Silver. Both shuffles carry one row for each record or trade; rejected rows
    are one row of each task.
    """
    good = F.size("reasons") == 0
    place = [F.when(good, F.col(c)).alias(c) for c in ("trade_id", *LINEAGE)]
    by_record = records.select(good.alias("good"), *place).groupBy("good", "trade_id", *LINEAGE).agg(
        F.count(F.lit(1)).alias("rows"))
    by_trade = by_record.groupBy("good", "trade_id").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("records"))

    def total(value: Column, when: Column = F.col("good")) -> Column:
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0))

    return by_trade.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("bronze_rows"),
        total(F.col("rows"), ~F.col("good")).alias("rejected_rows"),
        total(F.col("rows")).alias("clean_rows"),
        total(F.col("rows") - F.col("records")).alias("redelivered_rows"),
        total(F.col("records") - 1).alias("duplicate_rows"),
        F.count_if("good").alias("silver_rows"),
    )


def reconciled(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows of Silver, those of them without any day, and trades in Gold; nothing should be left over."""
    dated = F.coalesce("source_ts", "ingestion_time").isNotNull()
    of_silver = silver.agg(F.count(F.lit(1)).alias("silver_rows"), F.count_if(~dated).alias("undated_rows"))
    of_gold = gold.agg(F.coalesce(F.sum("trades"), F.lit(0)).alias("gold_trades"))
    left_over = F.col("silver_rows") - F.col("undated_rows") - F.col("gold_trades")
    return of_silver.select("*", of_gold.scalar().alias("gold_trades")).withColumn("left_over", left_over)


# Offsets of one topic partition that one task orders at most.
OFFSETS_AT_ONCE = 1 << 20


def missing_offsets(records: DataFrame, at_once: int = OFFSETS_AT_ONCE) -> DataFrame:
    """(kafka_topic, kafka_partition, first_offset, last_offset, records): the ranges of offsets that are not there.

    That is what a stream has lost when it goes on over data that the broker no longer has. Looked for is between the
    first and the last offset of each partition. Repeated records are one. A partition is cut into stretches of
    offsets, each ordered by itself; what lies between stretches is found on one row for each of them.
    """
    place, offset = ["kafka_topic", "kafka_partition"], F.col("kafka_offset")
    seen = records.filter(offset.isNotNull()).select(*place, "kafka_offset").distinct() \
        .withColumn("stretch", F.floor(offset / at_once))
    inside = Window.partitionBy(*place, "stretch").orderBy("kafka_offset")
    between = Window.partitionBy(*place).orderBy("stretch")
    stretches = seen.groupBy(*place, "stretch").agg(F.min("kafka_offset").alias("at"), F.max("kafka_offset").alias("until"))
    after = seen.select(*place, offset.alias("at"), F.lag("kafka_offset").over(inside).alias("before")).unionByName(
        stretches.select(*place, "at", F.lag("until").over(between).alias("before")))
    return after.filter(F.col("at") - F.col("before") > 1).select(
        *place, (F.col("before") + 1).alias("first_offset"), (F.col("at") - 1).alias("last_offset"),
        (F.col("at") - F.col("before") - 1).alias("records"))


def counted(df: DataFrame, observation: Observation, name: str = "rows") -> DataFrame:
    """Count the rows that flow to a sink while it is written, instead of computing everything again."""
    return df.observe(observation, F.count(F.lit(1)).alias(name))
