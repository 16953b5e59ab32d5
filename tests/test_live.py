"""Live cards as streams: prices that expire in state, volumes from panes of a minute."""

import os

import pytest
from helpers import millis, payload
from test_streaming import Feed

from tapeworks.operators import hot, marts
from tapeworks.sources import envelope as source
from tapeworks.streaming import runs
from tapeworks.streaming.live import (
    live_panes, read_live_prices, read_live_volume, start_live_prices, start_live_volume,
)

AT = "2024-05-01 10:00:00"


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def trades_of(stream):
    return hot.to_trades(source.to_bronze(stream), keep=("source_ts",))


def starter(start, tmp_path, every=10):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    return lambda s: start(trades_of(s), out, checkpoint, trigger=runs.CATCH_UP, every=every)


def prices(spark, tmp_path):
    return {r.symbol: r.price for r in read_live_prices(spark, str(tmp_path / "out")).collect()}


def folders(path):
    return [n for n in os.listdir(path) if n.startswith("batch_id=")]


def test_an_idle_symbol_goes_without_a_clock_at_the_reader(spark, feed, tmp_path):
    start, at = starter(start_live_prices, tmp_path), millis(AT)
    feed.send(payload(trade_id="1", symbol="A", price=1.0, trade_ts=at), payload(trade_id="2", symbol="B", trade_ts=at),
              payload(trade_id="n", symbol=None, price=5.0, trade_ts=at), ts=AT)
    feed.run(start)
    assert prices(spark, tmp_path) == {"A": 1.0, "B": 10.5, None: 5.0}
    # Later trades, an earlier one that comes after them, one without a price.
    feed.send(payload(trade_id="3", symbol="A", price=3.0, trade_ts=at + 1800000), ts="2024-05-01 10:30:00")
    feed.send(payload(trade_id="0", symbol="A", price=9.0, trade_ts=at + 60000),
              payload(trade_id="x", symbol="A", price=None, trade_ts=at + 1800500), ts="2024-05-01 10:30:01")
    feed.run(start)
    assert prices(spark, tmp_path) == {"A": 3.0, "B": 10.5, None: 5.0}
    feed.send(payload(trade_id="4", symbol="C", price=4.0, trade_ts=at + 3600000), ts="2024-05-01 11:00:00")
    feed.run(start)
    # Exactly an hour old is still there.
    assert prices(spark, tmp_path) == {"A": 3.0, "B": 10.5, None: 5.0, "C": 4.0}
    feed.send(payload(trade_id="5", symbol="C", price=4.5, trade_ts=at + 3600001), ts="2024-05-01 11:00:00.002")
    feed.run(start)
    assert prices(spark, tmp_path) == {"A": 3.0, "C": 4.5}
    # A trade too old by itself brings nothing back; a new one does.
    feed.send(payload(trade_id="6", symbol="B", price=6.0, trade_ts=at - 1), ts="2024-05-01 11:00:01")
    feed.send(payload(trade_id="7", symbol="B", price=7.0, trade_ts=at + 3601000), ts="2024-05-01 11:00:01")
    feed.run(start)
    assert prices(spark, tmp_path) == {"A": 3.0, "B": 7.0, "C": 4.5}


def test_trades_ahead_of_the_clock_and_ties(spark, feed, tmp_path):
    start, at = starter(start_live_prices, tmp_path), millis(AT)
    feed.send(payload(trade_id="w", symbol="W", price=7.0, trade_ts=millis("9999-01-01 00:00:00")),
              payload(trade_id="a", symbol="A", price=1.0, trade_ts=at), payload(trade_id="b", symbol="A", price=2.0, trade_ts=at),
              payload(trade_id="b", symbol="A", price=2.0, trade_ts=at), ts=AT)
    feed.run(start)
    feed.send(payload(trade_id="aa", symbol="A", price=3.0, trade_ts=at), ts=AT)
    feed.run(start)
    assert prices(spark, tmp_path) == {"A": 2.0}


def test_folder_and_state_hold_live_symbols_only(spark, feed, tmp_path):
    """Every batch has a symbol of its own, ten minutes after the last: seven are alive at a time."""
    start, at = starter(start_live_prices, tmp_path, every=4), millis(AT)
    seen = []
    for i in range(13):
        moment = at + 600_000 * i
        text = f"2024-05-01 {10 + i // 6}:{10 * (i % 6):02d}:00"
        feed.send(payload(trade_id=str(i), symbol=f"S{i}", price=float(i + 1), trade_ts=moment), ts=text)
        query = feed.run(start)
        operators = [s for p in query.recentProgress for s in p["stateOperators"]]
        seen.append(operators[-1]["numRowsTotal"])
    assert prices(spark, tmp_path) == {f"S{i}": float(i + 1) for i in range(6, 13)}
    assert len(folders(tmp_path / "out")) <= 5
    assert seen[-1] == 7


def test_volume_equals_the_batch_operator(spark, feed, tmp_path):
    start, at = starter(start_live_volume, tmp_path, every=2), millis(AT)
    steps = [  # minutes of the broker's clock, and of the trades
        (0, [0, 0, -30, -59]), (20, [20, 19, 3, -39]), (10, [9]), (45, [44, 45, 0]), (61, [61, 60, 1, 0]), (62, [2]), (90, [-300, 31])]
    for n, (clock, minutes) in enumerate(steps):
        text = f"2024-05-01 {10 + clock // 60}:{clock % 60:02d}:30"
        feed.send(*[payload(trade_id=f"{n}-{i}", symbol="AB"[i % 2], price=0.1 * (i + 1), quantity=1.1 + n, trade_ts=at + 60000 * m)
                    for i, m in enumerate(minutes)],
                  payload(trade_id=f"{n}-w", symbol="A", trade_ts=millis("9999-01-01 00:00:00")),
                  payload(trade_id=f"{n}-t", symbol="A", trade_ts=None), ts=text)
        feed.run(start)
        got = read_live_volume(spark, str(tmp_path / "out")).collect()
        everything = trades_of(spark.read.parquet(feed.path))
        now = everything.selectExpr("date_trunc('minute', max(source_ts)) AS now").first().now
        wanted = marts.live_volume(everything, now=now).collect()
        assert sorted(got) == sorted(wanted) and wanted
    assert len(folders(tmp_path / "out")) <= 4


def test_panes_that_left_the_window_go_but_not_the_clock(spark):
    rows = spark.sql("""
        SELECT s AS symbol, timestamp(m) AS minute, 1D AS volume, 2D AS notional, n AS trades, timestamp(c) AS source_ts, v AS version
        FROM VALUES ('A', '2024-05-01 08:00:00', 1L, '2024-05-01 10:00:30', 5L), ('A', '2024-05-01 08:01:00', 1L, '2024-05-01 08:01:10', 1L),
                    ('A', '2024-05-01 09:00:00', 1L, '2024-05-01 09:00:10', 2L), ('A', '2024-05-01 09:00:00', 3L, '2024-05-01 09:00:50', 3L),
                    (NULL, '2024-05-01 09:30:00', 1L, '2024-05-01 09:30:10', 4L) AS t(s, m, n, c, v)""")
    got = {(r.symbol, r.minute.hour, r.minute.minute): r.trades for r in live_panes(rows).collect()}
    assert got == {("A", 8, 0): 1, ("A", 9, 0): 3, (None, 9, 30): 1}
