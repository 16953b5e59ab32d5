from collections import Counter

import pytest
from helpers import bronze, envelope, millis, payload, trades, utc

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from tapeworks.operators import bars, hot
from tapeworks.sinks import files
from tapeworks.sources import envelope as source
from tapeworks.operators import enrich, marts
from tapeworks.streaming import runs
from tapeworks.streaming.bars import bars_step, closed_bars, compact_bars, read_bars, start_bars
from tapeworks.streaming.dedupe import _few_of_each, drop_repeats
from tapeworks.streaming.dual_sink import start_dual_sink
from tapeworks.streaming.enrichment import start_enrichment, with_late_quotes
from tapeworks.streaming.latest import newest_of, read_latest, start_latest_price


class Feed:
    """Envelope files that arrive one by one; each run of a stream takes what is there."""

    def __init__(self, spark, folder):
        self.spark, self.path, self.sent = spark, str(folder / "source"), 0

    def send(self, *values, topic="trades_raw", ts="2024-05-01 10:00:01"):
        df = envelope(self.spark, *values, topic=topic, ts=ts, first_offset=self.sent)
        self.sent += len(values)
        df.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return source.read_envelope_files(self.spark, self.path, stream=True, maxFilesPerTrigger="1")

    def run(self, start) -> StreamingQuery:
        query = start(self.stream())
        query.awaitTermination()
        return query


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def numbered(first, count, **fields):
    return [payload(trade_id=f"t{i}", **fields) for i in range(first, first + count)]


@pytest.mark.parametrize("fail_after_first_sink", [False, True])
def test_failed_batch_is_neither_lost_nor_doubled(spark, feed, tmp_path, fail_after_first_sink):
    for i in range(3):
        feed.send(*numbered(10 * i, 10), "{broken")
    bronze_path, hot_path = str(tmp_path / "bronze"), str(tmp_path / "hot")
    write_bronze, write_hot = files.bronze_batch_writer(bronze_path), files.month_batch_writer(hot_path, "trade_ts")
    failures = []

    def failing(write, active):
        def step(df, batch_id):
            if active and batch_id == 1 and not failures:
                if not fail_after_first_sink:
                    write(df.limit(3), batch_id)
                failures.append(batch_id)
                raise RuntimeError("sink is down")
            write(df, batch_id)
        return step

    def start(stream):
        return start_dual_sink(stream, failing(write_bronze, not fail_after_first_sink),
                               failing(write_hot, fail_after_first_sink), str(tmp_path / "cp"), runs.CATCH_UP)

    with pytest.raises(Exception, match="sink is down"):
        feed.run(start)
    feed.run(start)
    assert failures == [1]
    raw = spark.read.parquet(bronze_path)
    assert raw.count() == 33 and raw.select("kafka_offset").distinct().count() == 33
    trades = spark.read.parquet(hot_path)
    assert trades.count() == 30 and trades.select("trade_id").distinct().count() == 30


def test_repeated_batch_keeps_its_ingestion_time(spark, feed, tmp_path):
    feed.send(payload())
    seen = []

    def step(df, batch_id):
        seen.append(df.first().ingestion_time)
        if len(seen) == 1:
            raise RuntimeError("again")

    start = lambda stream: runs.start_batches(source.to_bronze(stream), step, str(tmp_path / "cp"), runs.CATCH_UP)
    with pytest.raises(Exception, match="again"):
        feed.run(start)
    feed.run(start)
    assert len(seen) == 2 and seen[0] == seen[1]


def test_restart_goes_on_where_it_stopped(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    start = lambda stream: runs.start_files(source.to_bronze(stream), out, str(tmp_path / "cp"), runs.CATCH_UP)
    for first in (0, 5):
        feed.send(*numbered(first, 5))
        feed.run(start)
    assert spark.read.parquet(out).count() == 10


def test_a_minute_over_several_batches_is_one_bar(spark, feed, tmp_path):
    at = millis("2024-05-01 10:00:00")
    for k, (price, ms) in enumerate([(5.0, 30000), (1.0, 1000), (9.0, 59000)]):
        feed.send(payload(trade_id=f"t{k}", price=price, trade_ts=at + ms))
    path = str(tmp_path / "bars")
    feed.run(lambda s: start_bars(hot.to_trades(s, "value"), path, str(tmp_path / "cp"), trigger=runs.CATCH_UP))
    assert spark.read.parquet(path).count() == 3
    (bar,) = read_bars(spark, path, months=[202405]).collect()
    assert (bar.open, bar.high, bar.low, bar.close, bar.trade_count) == (1.0, 9.0, 1.0, 9.0, 3)
    assert read_bars(spark, path, months=[202404]).count() == 0


def test_late_trade_misses_the_closed_bar_and_is_repaired(spark, feed, tmp_path):
    at = millis("2024-05-01 10:00:00")
    minute = 60000
    sent = [("a", 0), ("b", 10 * minute), ("c", 20 * minute), ("late", 1000), ("d", 40 * minute)]
    values = [payload(trade_id=i, trade_ts=at + ms) for i, ms in sent]
    for value in values:
        feed.send(value)
    path = str(tmp_path / "bars")
    feed.run(lambda s: runs.start_files(closed_bars(hot.to_trades(s, "value"), "5 minutes"), path,
                                        str(tmp_path / "cp"), runs.CATCH_UP))
    closed = spark.read.parquet(path)
    assert closed.filter("minute = timestamp'2024-05-01 10:00:00'").first().trade_count == 1
    trades = hot.to_trades(bronze(spark, *values))
    repaired = bars.repair_bars(closed, trades)
    assert sorted(repaired.collect()) == sorted(bars.ohlcv(trades).collect())
    assert repaired.count() > closed.count()


@pytest.mark.parametrize("split", [1, 8])
def test_repeats_are_dropped_across_batches(spark, feed, tmp_path, split):
    for _ in range(3):
        feed.send(*[payload(trade_id="hot")] * 20, *numbered(0, 5))
    out = str(tmp_path / "out")
    feed.run(lambda s: runs.start_files(
        drop_repeats(hot.to_trades(source.to_bronze(s), keep=("kafka_partition", "kafka_offset")), "1 hour", split=split),
        out, str(tmp_path / "cp"), runs.CATCH_UP))
    assert Counter(r.trade_id for r in spark.read.parquet(out).collect()) == Counter(
        ["hot", "t0", "t1", "t2", "t3", "t4"])


def test_repeats_of_a_key_need_one_state_and_few_rows(spark, feed, tmp_path):
    at = millis(AT)
    hot_key = [payload(trade_id="hot", trade_ts=at + 1000 * (i % 40)) for i in range(400)]
    feed.send(*hot_key, *[payload(trade_id=None)] * 3, *numbered(0, 5), payload(trade_id="timeless", trade_ts=None))
    feed.send(*hot_key, *numbered(3, 5))
    trades = lambda s: hot.to_trades(source.to_bronze(s), keep=("kafka_partition", "kafka_offset"))
    few = trades(spark.read.schema(feed.stream().schema).parquet(feed.path)).coalesce(1)
    few = few.mapInArrow(_few_of_each("trade_id", "trade_ts"), few.schema)
    assert Counter(r.trade_id for r in few.collect())["hot"] <= 4
    assert few.filter(f"trade_ts = timestamp_millis({at + 39000})").count() >= 1
    out = str(tmp_path / "out")
    query = feed.run(lambda s: runs.start_files(drop_repeats(trades(s), "1 hour"), out, str(tmp_path / "cp"), runs.CATCH_UP))
    got = spark.read.parquet(out).collect()
    assert Counter(r.trade_id for r in got) == Counter({None: 3, "hot": 1, "timeless": 1, **{f"t{i}": 1 for i in range(8)}})
    assert next(r.kafka_offset for r in got if r.trade_id == "hot") == 0
    assert len(query.lastProgress.stateOperators) == 1
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "true") == "true"


def test_rows_without_an_id_are_repeats_of_nothing(spark, feed, tmp_path):
    feed.send(*[payload(trade_id=None)] * 3, payload(trade_id="a"))
    feed.send(*[payload(trade_id=None)] * 3, payload(trade_id="a"))
    out = str(tmp_path / "out")
    feed.run(lambda s: runs.start_files(
        drop_repeats(hot.to_trades(source.to_bronze(s), keep=("kafka_partition", "kafka_offset")), "1 hour"),
        out, str(tmp_path / "cp"), runs.CATCH_UP))
    assert Counter(r.trade_id for r in spark.read.parquet(out).collect()) == Counter({None: 6, "a": 1})


def test_what_the_hot_table_cannot_hold_is_counted_and_kept(spark, feed, tmp_path):
    feed.send(payload(trade_id="a"), payload(trade_id="b", symbol=None), '{"price":NaN,"trade_id":"n","symbol":"S","side":"BUY","quantity":1.0,"trade_ts":1}')
    feed.send("{broken", payload(trade_id="c"))
    paths = {n: str(tmp_path / n) for n in ("bronze", "hot", "rejects")}
    counts = {}
    feed.run(lambda s: start_dual_sink(
        s, files.bronze_batch_writer(paths["bronze"]), files.month_batch_writer(paths["hot"], "trade_ts"),
        str(tmp_path / "cp"), runs.CATCH_UP, write_rejects=lambda df, n: files.write_batch(df, paths["rejects"], n),
        report=counts.__setitem__))
    assert counts == {0: {"bronze": 3, "hot": 2, "rejects": 1}, 1: {"bronze": 2, "hot": 1, "rejects": 1}}
    assert {r.trade_id for r in spark.read.parquet(paths["hot"]).collect()} == {"a", "n", "c"}
    assert sorted(r.reasons for r in spark.read.parquet(paths["rejects"]).collect()) == [
        "missing_symbol", "missing_trade_id,missing_symbol,missing_side,missing_price,missing_quantity,missing_trade_ts"]


AT = "2024-05-01 10:00:00"


def start_latest(tmp_path):
    return lambda s: start_latest_price(
        hot.to_trades(source.to_bronze(s), keep=("source_ts",)), str(tmp_path / "latest"), str(tmp_path / "cp"),
        trigger=runs.CATCH_UP)


def latest(spark, tmp_path):
    return {r.symbol: r.price for r in read_latest(spark, str(tmp_path / "latest")).collect()}


def test_latest_price_over_batches_expires_when_read(spark, feed, tmp_path):
    start, at = start_latest(tmp_path), millis(AT)
    feed.send(payload(trade_id="1", symbol="A", price=1.0, trade_ts=at), payload(trade_id="2", symbol="B", trade_ts=at), ts=AT)
    feed.run(start)
    feed.send(payload(trade_id="3", symbol="A", price=3.0, trade_ts=at + 1800000), ts="2024-05-01 10:30:00")
    feed.send(payload(trade_id="0", symbol="A", price=9.0, trade_ts=at + 60000), ts="2024-05-01 10:30:01")
    feed.run(start)
    assert latest(spark, tmp_path) == {"A": 3.0, "B": 10.5}
    feed.send(payload(trade_id="4", symbol="A", price=4.0, trade_ts=at + 3600001), ts="2024-05-01 11:00:01")
    feed.run(start)
    assert latest(spark, tmp_path) == {"A": 4.0}


def test_one_wrong_time_does_not_move_the_clock(spark, feed, tmp_path):
    start, at = start_latest(tmp_path), millis(AT)
    wrong = payload(trade_id="w", symbol="W", price=7.0, trade_ts=millis("9999-01-01 00:00:00"))
    feed.send(payload(trade_id="1", symbol="A", price=1.0, trade_ts=at), wrong, ts=AT)
    feed.run(start)
    feed.send(payload(trade_id="2", symbol="B", price=2.0, trade_ts=at + 1000), ts="2024-05-01 10:00:01")
    feed.run(start)
    assert latest(spark, tmp_path) == {"A": 1.0, "B": 2.0}
    trades = hot.to_trades(bronze(spark, payload(trade_id="1", symbol="A", price=1.0, trade_ts=at), wrong, ts=AT), keep=("source_ts",))
    assert {r.symbol: r.price for r in marts.latest_price(trades).collect()} == {"A": 1.0}
    assert [r.symbol for r in marts.live_volume(trades).collect()] == ["A"]
    assert [(r.trade_id, r.reasons) for r in marts.ahead_of_time(trades).collect()] == [("w", "time_ahead")]


def quote(ms, bid, at=AT, symbol="AAPL"):
    return '{"symbol":"%s","bid":%s,"ask":%s,"event_ts":%d}' % (symbol, bid, bid + 1, millis(at) + ms)


def test_enrichment_uses_quotes_of_earlier_batches(spark, feed, tmp_path):
    at = millis(AT)
    out, quotes, checkpoint = (str(tmp_path / n) for n in ("out", "quotes", "cp"))
    start = lambda s: start_enrichment(source.to_bronze(s), out, quotes, checkpoint, trigger=runs.CATCH_UP)
    feed.send(quote(0, 10.0), quote(1000, 11.0), quote(0, 99.0, at="2030-01-01 00:00:00"), topic="market_data_raw")
    feed.run(start)
    feed.send(payload(trade_id="a", trade_ts=at + 500), payload(trade_id="b", trade_ts=at + 2000),
              payload(trade_id="old", trade_ts=at + 700000), payload(trade_id="before", trade_ts=at - 1), "{broken",
              payload(trade_id="nobody", symbol=None), payload(trade_id="far", trade_ts=millis("9999-01-01 00:00:00")))
    feed.run(start)
    got = {r.trade_id: r.bid for r in spark.read.parquet(out).collect()}
    assert got == {"a": 10.0, "b": 11.0, "old": None, "before": None, None: None, "nobody": None, "far": None}
    feed.send(payload(trade_id="later", trade_ts=at + 3000))
    feed.run(start)
    assert {r.trade_id: r.bid for r in spark.read.parquet(out).collect()} == {**got, "later": 11.0}


def test_a_quote_one_batch_late_reaches_its_trade(spark, feed, tmp_path):
    at, minute = millis(AT), 60_000
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    start = lambda s: runs.start_files(
        with_late_quotes(source.to_bronze(s), "10 minutes", within="2 minutes"), out, checkpoint, runs.CATCH_UP)
    got = lambda: {r.trade_id: r.bid for r in spark.read.parquet(out).collect()}
    feed.send(payload(trade_id="a", trade_ts=at + 5000), payload(trade_id="b", trade_ts=at + 5 * minute),
              payload(trade_id="nobody", symbol=None, trade_ts=at), payload(trade_id="t", trade_ts=None))
    feed.run(start)
    assert got() == {"t": None}
    feed.send(quote(1000, 10.0), quote(4000, 11.0), quote(6000, 12.0), topic="market_data_raw")
    feed.run(start)
    feed.send(payload(trade_id="end", symbol="Z", trade_ts=at + 60 * minute))
    feed.send(quote(60 * minute, 1.0), topic="market_data_raw")
    feed.run(start)
    assert got() == {"t": None, "a": 11.0, "b": None, "nobody": None}


def test_quotes_are_looked_up_and_not_paired_with_every_trade(spark, feed, tmp_path):
    at, minute = millis(AT), 60_000
    start = lambda s: runs.start_files(
        with_late_quotes(source.to_bronze(s), "10 minutes", within="2 minutes"), str(tmp_path / "out"), str(tmp_path / "cp"),
        runs.CATCH_UP)
    nan = '{"price":NaN,"trade_id":"nan","symbol":"AAPL","side":"BUY","quantity":1.0,"trade_ts":%d}' % (at + 3 * minute)
    feed.send(*[payload(trade_id=f"t{i}", trade_ts=at + 10 * i, price=None if i % 7 == 0 else i / 3) for i in range(300)], nan,
              payload(trade_id="edge", trade_ts=at + 6 * minute), payload(trade_id="over", trade_ts=at + 6 * minute + 1))
    feed.send(*[quote(20 * i, i / 7) for i in range(150)], quote(20, 9.0), quote(20, 1.0).replace("2.0", "null"),
              quote(4 * minute, 5.0), topic="market_data_raw")
    feed.run(start)
    feed.send(payload(trade_id="end", trade_ts=at + 60 * minute))
    feed.send(quote(60 * minute, 1.0), topic="market_data_raw")
    query = feed.run(start)
    got = {r.trade_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 303 and got["edge"].bid == 5.0 and got["over"].bid is None
    for i in range(300):
        bid = 9.0 if i in (2, 3) else i // 2 / 7
        assert (got[f"t{i}"].bid, got[f"t{i}"].price) == (bid, None if i % 7 == 0 else i / 3)
    assert got["nan"].price != got["nan"].price and got["nan"].bid is None
    operators = [o for p in query.recentProgress for o in p.stateOperators]
    assert not any("Join" in o.operatorName for o in operators)


def test_stream_equals_batch_on_gaps(spark, feed, tmp_path):
    at = millis(AT)
    trades = [payload(trade_id=None, trade_ts=at + 10), payload(trade_id="s", symbol=None), payload(trade_id="t", trade_ts=None),
              '{"price":NaN,"trade_id":"n","symbol":"AAPL","side":"BUY","quantity":1.0,"trade_ts":%d}' % (at + 20), "{"]
    quotes = [quote(0, 10.0), quote(5, 20.0).replace("20.0", "null", 1)]
    feed.send(*quotes, topic="market_data_raw")
    feed.send(*trades)
    out = str(tmp_path / "out")
    feed.run(lambda s: start_enrichment(source.to_bronze(s), out, str(tmp_path / "q"), str(tmp_path / "cp"), trigger=runs.CATCH_UP))
    batch = enrich.with_quotes(hot.to_trades(bronze(spark, *trades)), hot.to_quotes(bronze(spark, *quotes)), "10 minutes")
    stored = spark.read.parquet(out).select(batch.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, batch.collect()))


def test_fifty_batches_become_few_files(spark, tmp_path):
    path = str(tmp_path / "bars")
    write = files.month_batch_writer(path, "minute")
    trades = [payload(trade_id=f"t{i:03}", price=float(i), trade_ts=millis(AT) + 7000 * i) for i in range(100)]
    for n in range(50):
        write(bars.partial_bars(hot.to_trades(bronze(spark, *trades[2 * n : 2 * n + 2]))), n)
    count = lambda: len(spark.read.parquet(path).inputFiles())
    before = read_bars(spark, path).collect()
    assert count() == 50
    for stop in (True, False):
        if stop:  # as if the run had stopped between the two renames
            finish, files._finish_compaction = files._finish_compaction, lambda *_: None
            compact_bars(spark, path, [202405])
            files._finish_compaction = finish
            assert count() == 50
        compact_bars(spark, path, [202405, 202406])
        assert count() == 1
        assert sorted(read_bars(spark, path).collect()) == sorted(before)
    write(bars.partial_bars(hot.to_trades(bronze(spark, *trades[:1]))), 50)
    assert count() == 2


def folders(path):
    import glob

    return sorted(glob.glob(f"{path}/**/batch_id=*", recursive=True))


def test_two_hundred_batches_stay_in_few_files(spark, tmp_path):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    path, most = str(tmp_path / "rows"), 0

    def write(batch, batch_id):  # as a batch writer does, without the time that a job takes
        home = f"{path}/month=202405/batch_id={batch_id}"
        os.makedirs(home, exist_ok=True)
        pq.write_table(pa.table({"symbol": ["S"], "n": [batch_id]}), f"{home}/part-0.parquet")

    step = runs.in_tiers(write, path, "month")
    nothing = spark.range(0)
    for i in range(200):
        step(nothing, i)
        if i in (10, 100, 150):
            step(nothing, i)  # a batch that is repeated replaces its own rows
        most = max(most, len(folders(path)))
    assert most <= 9 + 9 + 2 + 1
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == list(range(200))


def test_bars_are_merged_while_the_stream_runs(spark, tmp_path):
    path, rows = str(tmp_path / "bars"), []
    step = bars_step(path, tier=3)
    for i in range(11):
        new = [(f"{i}", f"S{i % 2}", float(i * 37 % 101), 0.5, f"2024-05-01 10:{i % 2:02}:{i:02}")]
        rows += new
        step(trades(spark, *new).coalesce(1), i)
    assert len(folders(path)) <= 2 + 2 + 2
    assert spark.read.parquet(path).count() < 11
    assert sorted(read_bars(spark, path).collect()) == sorted(bars.ohlcv(trades(spark, *rows)).collect())


def test_a_merge_that_stopped_half_way_is_completed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    for i in range(4):
        files.write_batch(spark.range(i, i + 1).withColumn("k", F.lit(i % 2)), path, i, ["k"])
        files.write_batch(spark.range(10 * i, 10 * i + 1).withColumn("k", F.lit(0)), f"{path}/k=9", i)
    for stop in (1, 2, 3):
        real, left = files.delete, [stop]

        def failing(spark_, folder):
            if "batch_id=" in folder or folder.endswith("_merged"):
                left[0] -= 1
                if not left[0]:
                    raise OSError("gone")
            real(spark_, folder)

        with monkeypatch.context() as broken:
            broken.setattr(files, "delete", failing)
            try:
                files.merge_batches(spark, path, 0, 3, "k")
            except OSError:
                pass
        files.merge_batches(spark, path, 0, 3, "k")
        assert sorted(r.id for r in spark.read.parquet(path).filter("k < 9").collect()) == [0, 1, 2, 3]
    assert len(folders(path)) == 3


def test_newest_prices_are_merged(spark, tmp_path):
    path = str(tmp_path / "latest")
    seen = spark.createDataFrame(
        [("S", 1.0, utc("2024-05-01 10:00:00"), "a", utc("2024-05-01 10:00:00")), ("S", 2.0, utc("2024-05-01 10:00:05"), "b", utc("2024-05-01 10:00:05")),
         ("T", 3.0, utc("2024-05-01 10:00:01"), "c", utc("2024-05-01 10:00:01")), ("S", None, None, None, utc("2024-05-01 10:00:09"))],
        "symbol string, price double, trade_ts timestamp, trade_id string, source_ts timestamp")
    for i in range(4):
        files.write_batch(seen.limit(i + 1), path, i)
    before = sorted(read_latest(spark, path).collect())
    files.merge_batches(spark, path, 0, 2, merge=newest_of)
    assert len(folders(path)) == 2 and sorted(read_latest(spark, path).collect()) == before
    assert [r.price for r in before] == [2.0, 3.0]
