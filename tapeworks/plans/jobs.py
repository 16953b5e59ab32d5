"""The daily jobs: Bronze to Silver, Gold, checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.times import month_key
from tapeworks.operators.gold import daily_trade_metrics, trade_date
from tapeworks.operators.quality import check, counted, not_null, raise_on_failure
from tapeworks.operators.silver import accepted, against_known, content, flagged, keep_newest, rejected, rejects
from tapeworks.schemas import SILVER
from tapeworks.session import shared_root
from tapeworks.sinks.files import clustered_by_day, scratch, staged
from tapeworks.sinks.keys import KeyIndex
from tapeworks.sinks.tables import append_table, clear_partition, location, replace_partitions, replace_table

# The daily run takes in what has arrived by then.
CUT_OFF = time(17, 0)


def cut_off(day: date) -> datetime:
    """Cut-off of a day, in UTC."""
    return datetime.combine(day, CUT_OFF)


def _utc(moment: datetime) -> datetime:
    """The moment in UTC without a zone; one without a zone is in UTC already."""
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def _bound(moment: datetime) -> Column:
    return F.lit(_utc(moment).isoformat(sep=" ")).cast("timestamp")


def arrived(bronze: DataFrame, since: datetime | None = None, as_of: datetime | None = None) -> DataFrame:
    """Records ingested after ``since`` and up to ``as_of``.

    On Bronze files by ingestion day the day is filtered too, so that only the days needed are opened.
    """
    dated = "ingest_date" in bronze.columns
    if since is not None:
        bronze = bronze.filter(F.col("ingestion_time") > _bound(since))
        bronze = bronze.filter(F.col("ingest_date") >= F.lit(_utc(since).date())) if dated else bronze
    if as_of is not None:
        bronze = bronze.filter(F.col("ingestion_time") <= _bound(as_of))
        bronze = bronze.filter(F.col("ingest_date") <= F.lit(_utc(as_of).date())) if dated else bronze
    return bronze


# --- how far the incremental runs have come ----------------------------------------------------------------

@dataclass(frozen=True)
class Progress:
    """Up to when, and up to which offset of each topic partition, records have been taken in."""

    as_of: datetime
    offsets: dict[tuple[str, int], int]


def read_progress(spark: SparkSession, silver: str) -> Progress | None:
    """What the last run of a Silver table has stored; one row for each partition of a topic."""
    name = f"{silver}_progress"
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.table(name).select(F.date_format("as_of", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "kafka_topic", "kafka_partition",
                                    "kafka_offset").collect()
    as_of = max((datetime.fromisoformat(r[0]) for r in rows), default=None)
    return as_of and Progress(as_of, {(r[1], r[2]): r[3] for r in rows if r[3] is not None})


def not_taken_yet(bronze: DataFrame, progress: Progress | None, as_of: datetime | None) -> DataFrame:
    """Records up to ``as_of`` that no run has taken in, whenever that run was.

    That is what was ingested after the last run's time, and what stands at a higher offset than that run has seen:
    records stamped before its time but committed after it. Records of a topic partition become visible in the
    order of their offsets, so there is nothing else. Both are literals, which files without such records are
    skipped by. A record that has no place in a topic is looked at by every run; Silver takes its trade once.
    """
    if progress is None:
        return arrived(bronze, None, as_of)
    new = F.col("ingestion_time") > _bound(progress.as_of)
    known = F.lit(False)
    for (topic, partition), offset in sorted(progress.offsets.items()):
        here = (F.col("kafka_topic") == topic) & (F.col("kafka_partition") == partition)
        new = new | (here & (F.col("kafka_offset") > offset))
        known = known | here
    return arrived(bronze, None, as_of).filter(F.coalesce(new, F.lit(False)) | ~F.coalesce(known, F.lit(False)))


def _reached(records: DataFrame, before: Progress | None, as_of: datetime | None) -> Progress | None:
    """Progress after a run that has taken in the records; one row for each topic partition is collected."""
    places = records.groupBy("kafka_topic", "kafka_partition").agg(
        F.max("kafka_offset"), F.date_format(F.max("ingestion_time"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).collect()
    offsets = dict(before.offsets) if before else {}
    for topic, partition, offset, _ in places:
        offsets[topic, partition] = max(offset, offsets.get((topic, partition), offset))
    moments = [datetime.fromisoformat(p[3]) for p in places if p[3]] if as_of is None else [_utc(as_of)]
    moments += [before.as_of] if before else []
    return Progress(max(moments), offsets) if moments else None


def _store_progress(spark: SparkSession, silver: str, progress: Progress | None, root: str | None) -> None:
    if progress is None:
        return
    rows = [(str(progress.as_of), t, p, o) for (t, p), o in progress.offsets.items()] or [(str(progress.as_of), None, None, None)]
    stored = spark.createDataFrame(rows, "as_of string, kafka_topic string, kafka_partition int, kafka_offset long")
    replace_table(stored.withColumn("as_of", F.col("as_of").cast("timestamp")), f"{silver}_progress", root)


def silver_keys(spark: SparkSession, silver: str, root: str | None) -> KeyIndex:
    """The index of Silver's keys with a hash of what each trade says.

    It is made anew from Silver where it is not that of the table as it is: at first, after a full build, or after a run
    that failed between the two.
    """
    home = f"{root or shared_root(spark) + '/tapeworks'}/{silver.split('.')[-1]}_keys"
    index, of = KeyIndex(spark, home, "trade_id"), location(spark, silver)
    if not index.is_of(of):
        index.build(spark.table(silver).select("trade_id", content().alias("content")), of)
    return index


# --- Silver ------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class SilverRun:
    """What a run has done: rows written, the days its records belong to (None: all), and how far it has come."""

    rows: int
    days: list[date] | None
    reached: Progress | None


def _silver_run(
    spark: SparkSession, bronze: DataFrame, silver: str, mode: str, root: str | None, since: datetime | None,
    as_of: datetime | None, rejects: str | None,
) -> SilverRun:
    rows = Observation()
    if mode not in ("full", "incremental"):
        raise ValueError("mode is full or incremental")
    before = read_progress(spark, silver) if mode == "incremental" else None
    taken = arrived(bronze, since, as_of) if mode == "full" or since is not None else not_taken_yet(bronze, before, as_of)
    with scratch(spark, "silver-records") as folder:
        records = flagged(taken)
        # What is looked at a second time has to be the rows that were read, or come before they are read: what arrives
        # between is taken again by the next run, and is known then. So records are kept for the rejects only.
        if rejects is not None:
            records = staged(records, f"{folder}/records")
        reached = _reached(records if mode == "incremental" and rejects is not None else taken, before, as_of)
        newest, lost = keep_newest(accepted(records)), rejected(records)
        days: list[date] | None = None
        if mode == "full" or not spark.catalog.tableExists(silver):
            anew = clustered_by_day(newest.select(SILVER.fieldNames()), trade_date())
            replace_table(counted(anew, rows), silver, root)
        else:
            index = silver_keys(spark, silver, root)
            newest = staged(newest, f"{folder}/newest")
            known = staged(index.known(newest.select("trade_id")), f"{folder}/known")
            compared = against_known(newest, known)
            new = compared.filter(F.col("known").isNull()).select(SILVER.fieldNames())
            index.begin()
            append_table(counted(new, rows), silver, root)
            index.add(new.select("trade_id", content().alias("content")), rows.get["rows"])
            changed = compared.filter(F.col("known") != content())
            lost = lost.unionByName(changed.select(
                *[c for c in lost.columns if c != "reasons"], F.array(F.lit("changed_trade")).alias("reasons")))
            found = newest.select(trade_date().alias("day")).distinct().collect()
            days = sorted(r.day for r in found if r.day is not None)
        if rejects is not None:
            keep_rejects(lost, rejects, root, since or (before and before.as_of), as_of)
        return SilverRun(rows.get["rows"], days, reached)


def bronze_to_silver(
    spark: SparkSession, bronze: DataFrame, silver: str, *, mode: str = "full", root: str | None = None,
    since: datetime | None = None, as_of: datetime | None = None, rejects: str | None = None,
) -> int:
    """Build Silver anew (``full``) or add what it does not have yet (``incremental``); returns rows written.

    A full build clusters Silver by day, as increments do by themselves: Gold then reads the days it renews.

    An incremental run takes the records that no run has taken yet, or with ``since`` those ingested after it. A
    record that changes a trade Silver already has is not applied but goes to the rejects; a full run keeps the
    newest of all. Running the same increment again adds nothing.
    """
    run = _silver_run(spark, bronze, silver, mode, root, since, as_of, rejects)
    _store_progress(spark, silver, run.reached, root)
    return run.rows


def keep_rejects(
    lost: DataFrame, name: str, root: str | None, since: datetime | None = None, as_of: datetime | None = None
) -> None:
    """Keep what a run has rejected, under the period that it took in; the same period again replaces it.

    The reasons are stored as one comma-separated text.
    """
    period = "..".join(_utc(m).strftime("%Y%m%dT%H%M%S%f") if m else "" for m in (since, as_of))
    spark, rows = lost.sparkSession, Observation()
    labelled = lost.withColumn("reasons", F.array_join("reasons", ",")).withColumn("period", F.lit(period))
    if spark.catalog.tableExists(name):
        replace_partitions(counted(labelled, rows), name, root, ["period"])
        if not rows.get["rows"]:
            clear_partition(spark, name, root, "period", period)
    else:
        replace_table(labelled, name, root, by=["period"])


def quarantine(
    spark: SparkSession, bronze: DataFrame, name: str, *, root: str | None = None,
    since: datetime | None = None, as_of: datetime | None = None,
) -> None:
    """Keep the records of a period that Silver does not take, with the reasons. Duplicates are those within it."""
    with scratch(spark, "parsed-records") as folder:
        keep_rejects(rejects(arrived(bronze, since, as_of), folder), name, root, since, as_of)


# --- Gold --------------------------------------------------------------------------------------------------

def gold_of_days(silver: DataFrame, days: Sequence[date]) -> DataFrame:
    """Daily metrics of some days. The days are literals (a calendar has few), so the scan of Silver skips files by
    their time range."""
    first, end = F.lit(min(days)).cast("timestamp"), F.lit(max(days) + timedelta(days=1)).cast("timestamp")
    in_span = F.col("source_ts").isNull() | ((F.col("source_ts") >= first) & (F.col("source_ts") < end))
    return daily_trade_metrics(silver.filter(in_span & trade_date().isin(list(days))))


def _by_month(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("trade_month", month_key(F.col("trade_date"))).hint("rebalance", "trade_month")


def build_gold(
    spark: SparkSession, silver: str, gold: str, *, root: str | None = None, since: datetime | None = None,
    days: Sequence[date] | None = None,
) -> None:
    """Build Gold anew, or only some days: those given, or with ``since`` those of Silver rows ingested after it.

    Gold has a folder for each month, whose number is its last column: a day alone would be a tiny file. Only the
    folders of the months with these days are written, with their other days as they were.
    """
    source = spark.table(silver)
    if not spark.catalog.tableExists(gold) or (since is None and days is None):
        replace_table(_by_month(daily_trade_metrics(source)), gold, root, by=["trade_month"])
        return
    if days is None:
        touched = source.filter(F.col("ingestion_time") > _bound(since))
        days = [r.day for r in touched.select(trade_date().alias("day")).distinct().collect() if r.day is not None]
    if days:
        months = sorted({d.year * 100 + d.month for d in days})
        stored = spark.table(gold).filter(F.col("trade_month").isin(months) & ~F.col("trade_date").isin(list(days)))
        with scratch(spark, "gold-months") as folder:
            anew = _by_month(stored.drop("trade_month").unionByName(gold_of_days(source, days)))
            replace_partitions(staged(anew, folder), gold, root, ["trade_month"])


def check_gold(spark: SparkSession, gold: str) -> DataFrame:
    return check(spark.table(gold), not_null("trade_date", "symbol"))


def build_and_check_gold(
    spark: SparkSession, silver: str, gold: str, *, root: str | None = None, since: datetime | None = None,
    days: Sequence[date] | None = None,
) -> DataFrame:
    """The checks follow the build and stop the run when one fails."""
    build_gold(spark, silver, gold, root=root, since=since, days=days)
    results = check_gold(spark, gold)
    raise_on_failure(results)
    return results


def run_daily(
    spark: SparkSession, bronze: DataFrame, silver: str, gold: str, *, day: date | None = None,
    mode: str = "full", root: str | None = None, since: datetime | None = None, rejects: str | None = None,
) -> None:
    """Silver and the rejects, then Gold, then the checks, over what had arrived at the day's cut-off.

    An incremental run takes what no run has taken yet, however long ago the last one was, and renews the days that
    these records belong to. How far it has come is stored when all is done: a run that fails is done again whole.
    """
    as_of = cut_off(day) if day is not None else None
    run = _silver_run(spark, bronze, silver, mode, root, since, as_of, rejects)
    build_and_check_gold(spark, silver, gold, root=root, days=run.days)
    _store_progress(spark, silver, run.reached, root)
