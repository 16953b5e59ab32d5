from datetime import date, datetime, timedelta, timezone

import pytest
from helpers import bronze, payload

from pyspark.sql import functions as F
from tapeworks import cli
from tapeworks.operators.gold import daily_trade_metrics
from tapeworks.operators import quality
from tapeworks.operators.silver import to_silver
from tapeworks.plans import jobs

DAY1, DAY2 = "2024-05-01 10:00:00", "2024-05-02 10:00:00"


def two_days(spark):
    first = bronze(spark, payload(trade_id="a"), payload(trade_id="b"), "{", ts=DAY1, ingested=DAY1)
    second = bronze(
        spark, payload(trade_id="a", price=99.0), payload(trade_id="c"), payload(trade_id="c"),
        (payload(trade_id="late"), DAY1), ts=DAY2, ingested=DAY2)
    return first, second


def gold_rows(df):
    return sorted(tuple(r) for r in df.select(sorted(set(df.columns) - {"ingested_at", "trade_month"})).collect())


def test_full_build_keeps_the_newest(spark, tmp_path, table_name):
    first, second = two_days(spark)
    name = table_name("silver")
    assert jobs.bronze_to_silver(spark, first.unionByName(second), name, root=str(tmp_path)) == 4
    assert {r.trade_id: r.price for r in spark.table(name).collect()} == {"a": 99.0, "b": 10.5, "c": 10.5, "late": 10.5}


def test_records_are_kept_for_rejects_only(spark, tmp_path, table_name, monkeypatch):
    first, second = two_days(spark)
    written, write = [], jobs.staged
    monkeypatch.setattr(jobs, "staged", lambda df, path: written.append(path.split("/")[-1]) or write(df, path))
    name, other = table_name("silver"), table_name("silver")
    for lost, into in ((None, name), (table_name("lost"), other)):
        for records in (first, second, second):
            jobs.bronze_to_silver(spark, records, into, mode="incremental", root=str(tmp_path), rejects=lost)
        if lost is None:
            assert "records" not in written
    assert written.count("records") == 3
    got = [sorted((r.trade_id, r.price) for r in spark.table(t).collect()) for t in (name, other)]
    assert got[0] == got[1] == [("a", 10.5), ("b", 10.5), ("c", 10.5), ("late", 10.5)]
    assert jobs.read_progress(spark, name) == jobs.read_progress(spark, other)


def test_full_build_is_clustered_by_day(spark, sf_dir, tmp_path, table_name):
    import glob

    import pyarrow.parquet as pq
    from tapeworks.plans import fixtures as fx

    name = table_name("silver")
    jobs.bronze_to_silver(spark, fx.cold_bronze(spark, sf_dir), name, root=str(tmp_path))
    for path in glob.glob(str(tmp_path / name / "**" / "*.parquet"), recursive=True):
        days = [(r["source_ts"].date(), r["symbol"]) for r in pq.read_table(path, columns=["source_ts", "symbol"]).to_pylist()]
        assert days == sorted(days)


def test_increment_adds_only_new_trades(spark, tmp_path, table_name):
    first, second = two_days(spark)
    name, root = table_name("silver"), str(tmp_path)
    both = first.unionByName(second)
    since = datetime(2024, 5, 1, 17)
    assert jobs.bronze_to_silver(spark, both, name, mode="incremental", root=root, as_of=since) == 2
    assert jobs.bronze_to_silver(spark, both, name, mode="incremental", root=root) == 2
    assert jobs.bronze_to_silver(spark, both, name, mode="incremental", root=root) == 0
    assert jobs.bronze_to_silver(spark, both, name, mode="incremental", root=root, since=since) == 0
    assert {r.trade_id: r.price for r in spark.table(name).collect()} == {"a": 10.5, "b": 10.5, "c": 10.5, "late": 10.5}
    with pytest.raises(ValueError):
        jobs.bronze_to_silver(spark, both, name, mode="other", root=root)


def records(spark, *rows):
    """(payload, ingested, partition, offset) as Bronze records."""
    frames = [bronze(spark, value, ts=at, ingested=at).withColumns({
        "kafka_partition": F.lit(p).cast("int"), "kafka_offset": F.lit(o).cast("long")}) for value, at, p, o in rows]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def ids(spark, name):
    return sorted(r.trade_id for r in spark.table(name).collect())


def test_a_missed_day_is_made_up_for(spark, tmp_path, table_name):
    days = [(payload(trade_id=i), f"2024-05-0{d} 10:00:00", 0, d) for d, i in ((1, "a"), (2, "b"), (3, "c"))]
    silver, gold, root = table_name("silver"), table_name("gold"), str(tmp_path)
    for day in (1, 3):
        jobs.run_daily(spark, records(spark, *days), silver, gold, day=date(2024, 5, day), mode="incremental", root=root)
    assert ids(spark, silver) == ["a", "b", "c"]
    assert gold_rows(spark.table(gold)) == gold_rows(daily_trade_metrics(spark.table(silver)))


def test_a_record_committed_after_the_cut_off_is_taken_by_the_next_run(spark, tmp_path, table_name):
    seen = [(payload(trade_id="a"), "2024-05-01 16:00:00", 0, 1), (payload(trade_id="z"), "2024-05-01 16:59:00", 1, 5)]
    late = [(payload(trade_id="b"), "2024-05-01 16:59:58", 0, 2), (payload(trade_id="p"), "2024-05-01 10:00:00", 2, 0)]
    silver, gold, root = table_name("silver"), table_name("gold"), str(tmp_path)
    jobs.run_daily(spark, records(spark, *seen), silver, gold, day=date(2024, 5, 1), mode="incremental", root=root)
    jobs.run_daily(spark, records(spark, *seen, *late), silver, gold, day=date(2024, 5, 2), mode="incremental", root=root)
    assert ids(spark, silver) == ["a", "b", "p", "z"]
    assert gold_rows(spark.table(gold)) == gold_rows(daily_trade_metrics(spark.table(silver)))


def test_a_failed_run_is_done_again(spark, tmp_path, table_name, monkeypatch):
    first, second = two_days(spark)
    silver, gold, lost, root = table_name("silver"), table_name("gold"), table_name("lost"), str(tmp_path)
    both = first.unionByName(second)
    run = lambda day: jobs.run_daily(spark, both, silver, gold, day=day, mode="incremental", root=root, rejects=lost)
    run(date(2024, 5, 1))
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "build_and_check_gold", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(date(2024, 5, 2))
    for _ in range(2):
        run(date(2024, 5, 2))
        assert ids(spark, silver) == ["a", "b", "c", "late"]
        assert gold_rows(spark.table(gold)) == gold_rows(daily_trade_metrics(spark.table(silver)))
    # A trade that the failed run had already added is no change of itself.
    assert sorted(r.reasons for r in spark.table(lost).collect()) == ["changed_trade", "duplicate_trade_id", "unparsable"]


def test_changes_are_kept_apart_from_repeats(spark, tmp_path, table_name):
    at = "2024-05-01 10:00:00"
    silver, lost, root = table_name("silver"), table_name("lost"), str(tmp_path)
    jobs.bronze_to_silver(spark, records(spark, (payload(trade_id="a"), at, 0, 1), (payload(trade_id="b"), at, 0, 2)), silver,
                          mode="incremental", root=root)
    more = records(spark, (payload(trade_id="a"), at, 0, 3), (payload(trade_id="b", price=99.0), at, 0, 4))
    assert jobs.bronze_to_silver(spark, more, silver, mode="incremental", root=root, rejects=lost) == 0
    assert [(r.trade_id, r.price, r.reasons) for r in spark.table(lost).collect()] == [("b", 99.0, "changed_trade")]


def test_times_with_a_zone(spark):
    df = records(spark, (payload(), "2024-05-01 21:00:00", 0, 1)).withColumn("ingest_date", F.to_date("ingestion_time"))
    zone = timezone(timedelta(hours=5))
    assert jobs.arrived(df, since=datetime(2024, 5, 2, 1, 0, tzinfo=zone)).count() == 1
    assert jobs.arrived(df, since=datetime(2024, 5, 2, 2, 0, tzinfo=zone)).count() == 0
    assert jobs.arrived(df, as_of=datetime(2024, 5, 2, 2, 0, tzinfo=zone)).count() == 1


def test_incremental_gold_equals_a_full_build(spark, tmp_path, table_name):
    first, second = two_days(spark)
    silver, gold, root = table_name("silver"), table_name("gold"), str(tmp_path)
    both = first.unionByName(second)
    jobs.run_daily(spark, both, silver, gold, day=date(2024, 5, 1), mode="incremental", root=root)
    assert [r.trades for r in spark.table(gold).collect()] == [2]
    for _ in range(2):
        jobs.run_daily(spark, both, silver, gold, day=date(2024, 5, 2), mode="incremental", root=root)
        assert gold_rows(spark.table(gold)) == gold_rows(daily_trade_metrics(spark.table(silver)))
    assert {r.trade_date.day: r.trades for r in spark.table(gold).collect()} == {1: 3, 2: 1}


def test_untouched_days_are_kept_as_they_are(spark, tmp_path, table_name):
    silver, gold, root = table_name("silver"), table_name("gold"), str(tmp_path)
    first, second = two_days(spark)
    jobs.run_daily(spark, first, silver, gold, day=date(2024, 5, 1), root=root)
    stamp = spark.table(gold).first().ingested_at
    only_second = second.filter("kafka_offset in (1, 2)")
    jobs.bronze_to_silver(spark, only_second, silver, mode="incremental", root=root)
    jobs.build_gold(spark, silver, gold, root=root, since=datetime(2024, 5, 1, 17))
    stamps = {r.trade_date.day: r.ingested_at for r in spark.table(gold).collect()}
    assert stamps[1] == stamp and stamps[2] > stamp


def test_quarantine(spark, tmp_path, table_name):
    first, second = two_days(spark)
    name, root = table_name("rejected"), str(tmp_path)
    since = datetime(2024, 5, 1, 17)
    both = first.unionByName(second)
    jobs.quarantine(spark, both, name, root=root, as_of=since)
    assert [r.reasons for r in spark.table(name).collect()] == ["unparsable"]
    for _ in range(2):  # the same period again replaces what it had
        jobs.quarantine(spark, both, name, root=root, since=since)
        assert sorted((r.trade_id or "", r.reasons) for r in spark.table(name).collect()) == [
            ("", "unparsable"), ("c", "duplicate_trade_id")]


def test_cut_off(spark):
    df = bronze(spark, payload(), ingested="2024-05-01 17:00:00").unionByName(
        bronze(spark, payload(), ingested="2024-05-01 17:00:00.001"))
    assert jobs.arrived(df, as_of=jobs.cut_off(date(2024, 5, 1))).count() == 1
    assert jobs.arrived(df, since=jobs.cut_off(date(2024, 5, 1))).count() == 1


def test_only_the_needed_days_are_opened(spark, tmp_path):
    from helpers import final_plan
    from tapeworks.sinks.files import write_bronze

    for df in two_days(spark):
        write_bronze(df, str(tmp_path / "bronze"))
    stored = spark.read.parquet(str(tmp_path / "bronze"))
    recent = to_silver(jobs.arrived(stored, since=datetime(2024, 5, 1, 17)))
    assert "PartitionFilters: [isnotnull(ingest_date" in final_plan(recent)
    assert recent.count() == 3


def test_failing_check_stops_the_run(spark, tmp_path, table_name, monkeypatch):
    first, _ = two_days(spark)
    silver, gold = table_name("silver"), table_name("gold")
    monkeypatch.setattr(jobs, "not_null", lambda *columns: quality.not_null("avg_sell_price"))
    with pytest.raises(quality.QualityError, match="avg_sell_price"):
        jobs.run_daily(spark, first, silver, gold, root=str(tmp_path))


def test_command_line(spark, tmp_path, table_name):
    from tapeworks.sinks.files import write_bronze

    path, root = str(tmp_path / "bronze"), str(tmp_path / "tables")
    for df in two_days(spark):
        write_bronze(df, path)
    silver, gold = table_name("silver"), table_name("gold")
    cli.main(["silver", "--bronze", path, "--silver", silver, "--root", root], spark)
    cli.main(["gold", "--silver", silver, "--gold", gold, "--root", root], spark)
    assert spark.table(gold).count() == 2
    cli.main(["daily", "--bronze", path, "--silver", silver, "--gold", gold, "--root", root, "--day", "2024-05-01"], spark)
    assert spark.table(gold).count() == 1
    lost = spark.table(f"{silver}_rejects").filter("period = '..20240501T170000000000'")
    assert [r.reasons for r in lost.collect()] == ["unparsable"]
    with pytest.raises(SystemExit):
        cli.main(["stream"], spark)
