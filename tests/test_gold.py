from datetime import date

import pytest
from helpers import final_plan, silver, utc

from pyspark.sql import functions as F
from tapeworks.operators import marts
from tapeworks.operators.gold import daily_trade_metrics, gold_base
from tapeworks.schemas import SILVER


def test_only_buys(spark):
    df = silver(spark, ("a", "S", "buy", 10.0, 2.0, "2024-05-01 10:00:00"),
                ("b", "S", "buy", 20.0, 2.0, "2024-05-01 23:59:59.999"))
    row = daily_trade_metrics(df).first()
    assert (row.trade_date, row.trades) == (date(2024, 5, 1), 2)
    assert (row.buy_qty, row.sell_qty, row.net_qty) == (4.0, 0.0, 4.0)
    assert (row.buy_notional, row.sell_notional, row.gross_notional) == (60.0, 0.0, 60.0)
    assert (row.avg_buy_price, row.avg_sell_price) == (15.0, None)
    assert row.ingested_at is not None


def test_side_is_compared_without_case(spark):
    df = silver(spark, ("a", "S", "SELL", 10.0, 3.0, "2024-05-01 10:00:00"),
                ("b", "S", "other", 10.0, 5.0, "2024-05-01 10:00:00"))
    row = daily_trade_metrics(df).first()
    assert (row.trades, row.buy_qty, row.sell_qty, row.avg_buy_price, row.avg_sell_price) == (2, 0.0, 3.0, None, 10.0)


def test_zero_quantity_has_no_average(spark):
    row = daily_trade_metrics(silver(spark, ("a", "S", "buy", 10.0, 0.0, "2024-05-01 10:00:00"))).first()
    assert row.avg_buy_price is None


def test_date_falls_back_to_ingestion(spark):
    at = utc("2024-05-02 01:00:00")
    rows = [("a", "S", 1.0, 1.0, "buy", None, None, at), ("b", "S", 1.0, 1.0, "buy", None, None, None)]
    got = gold_base(spark.createDataFrame(rows, SILVER)).collect()
    assert [r.trade_date for r in got] == [date(2024, 5, 2)]


def test_one_shuffle_with_fixed_width_buffers(spark, sf_dir):
    path = f"{sf_dir}/lineitem.parquet"
    df = spark.read.parquet(path).select(
        F.lit("S").alias("symbol"), F.lit("buy").alias("side"), F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"), F.col("l_shipdate").cast("timestamp").alias("source_ts"),
        F.col("l_shipdate").cast("timestamp").alias("ingestion_time"), "l_tax")
    plan = final_plan(daily_trade_metrics(df))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
    assert "l_tax" not in plan.split("ReadSchema")[1]


def test_pnl(spark):
    df = silver(
        spark,
        ("a", "S", "buy", 10.0, 5.0, "2024-05-01 10:00:00"),
        ("b", "S", "sell", 12.0, 2.0, "2024-05-02 10:00:00"),
        ("c", "S", "sell", 11.0, 3.0, "2024-05-03 10:00:00"),
    )
    got = [(r.cash, r.position, r.mark, r.pnl) for r in marts.daily_pnl(df).orderBy("trade_date").collect()]
    assert got == [(-50.0, 5.0, 10.0, 0.0), (24.0, 3.0, 12.0, 10.0), (33.0, 0.0, 11.0, -3.0)]
    total = marts.portfolio_summary(df).first()
    assert (total.position, total.last_price, total.market_value, total.total_pnl) == (0.0, 11.0, 0.0, 7.0)
    assert (total.buy_vwap, total.sell_vwap) == (10.0, 11.4)
    assert marts.active_positions(df).count() == 0


def test_risk(spark):
    closes = [100.0, 110.0, 99.0, 120.0]
    df = silver(spark, *[(str(i), "S", "buy", c, 1.0, f"2024-05-0{i + 1} 10:00:00") for i, c in enumerate(closes)])
    rows = marts.risk_metrics(df).orderBy("trade_date").collect()
    assert [r.close for r in rows] == closes
    assert rows[0].daily_return is None and rows[0].volatility is None
    assert [round(r.daily_return, 6) for r in rows[1:]] == [0.1, -0.1, 0.212121]
    assert [round(r.drawdown, 6) for r in rows] == [0.0, 0.0, -0.1, 0.0]
    assert [round(r.max_drawdown, 6) for r in rows] == [0.0, 0.0, -0.1, -0.1]


def test_latest_price_expires(spark):
    df = silver(
        spark,
        ("a", "OLD", "buy", 1.0, 1.0, "2024-05-01 08:59:59"),
        ("b", "S", "buy", 2.0, 1.0, "2024-05-01 09:30:00"),
        ("d", "S", "buy", 4.0, 1.0, "2024-05-01 10:00:00"),
        ("c", "S", "buy", 3.0, 1.0, "2024-05-01 10:00:00"),
    )
    assert [(r.symbol, r.price, r.trade_id) for r in marts.latest_price(df).collect()] == [("S", 4.0, "d")]
    later = utc("2024-05-01 10:45:00")
    assert [r.symbol for r in marts.latest_price(df, "1 hour", later).collect()] == ["S"]
    assert marts.latest_price(df, "10 minutes", later).count() == 0
    assert [(r.symbol, r.volume, r.notional) for r in marts.live_volume(df).collect()] == [("S", 3.0, 9.0)]


def test_quotes_of_any_size(spark):
    from helpers import quotes

    at = "2024-05-01 10:00:01"
    (bar,) = marts.quote_bars(quotes(spark, ("S", 3e-9, 5e-9, at), ("S", 3e-9, 4e-9, at))).collect()
    assert (bar.min_mid, bar.max_mid, bar.min_spread, bar.max_spread) == (3.5e-9, 4e-9, 4e-9 - 3e-9, 5e-9 - 3e-9)
    assert bar.avg_mid == pytest.approx(3.75e-9, rel=1e-12) and bar.avg_spread == pytest.approx(1.5e-9, rel=1e-12)


def test_rolling_deviation(spark):
    import random
    import statistics

    rng = random.Random(2)
    rows = [(k, i, None if i % 9 == 4 else rng.choice([0.0, rng.gauss(0, 0.02), rng.gauss(0, 100)])) for k in "ab" for i in range(60)]
    df = spark.createDataFrame(rows, "k string, i int, x double")
    for width in (2, 5, 20):
        found = df.withColumn("d", marts.rolling_deviation("x", ["k"], "i", width)).collect()
        for r in found:
            last = [x for k, i, x in rows if k == r.k and r.i - width < i <= r.i and x is not None]
            assert r.d is None if len(last) < 2 else r.d == pytest.approx(statistics.stdev(last), abs=1e-11, rel=1e-10)
    assert sorted(map(str, found)) == sorted(map(str, df.repartition(7).withColumn("d", marts.rolling_deviation("x", ["k"], "i", 20)).collect()))
