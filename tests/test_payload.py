"""How single payloads come out of parsing."""

import math

import pytest
from helpers import bronze, millis, naive, payload, utc

from pyspark.sql import functions as F
from tapeworks.operators.hot import storable, to_hot
from tapeworks.operators.silver import parse_trades, reject_reasons, to_silver

GOOD = dict(trade_id="a", symbol="AAPL", side="BUY", price=10.5, quantity=2.0)


def parsed(spark, raw):
    df = parse_trades(bronze(spark, raw))
    return df.withColumn("reasons", reject_reasons(df)).first()


def test_good_record(spark):
    row = parsed(spark, payload())
    assert {k: row[k] for k in GOOD} == GOOD
    assert naive(row.trade_ts) == naive(utc("2024-05-01 10:00:00.250"))
    assert row.reasons == []


@pytest.mark.parametrize("raw", ["{not json", '{"trade_id":"a","price":1', "", None, '[{"trade_id":"a"}]', "5", "[]"])
def test_unparsable_record_has_no_values(spark, raw):
    row = parsed(spark, raw)
    assert [row[k] for k in GOOD] == [None] * 5 and row.trade_ts is None
    assert row.reasons == ["unparsable"]


@pytest.mark.parametrize("change, reasons", [
    (dict(price="101.5"), ["missing_price"]),
    (dict(price=float("nan")), ["missing_price"]),
    (dict(symbol=None), ["missing_symbol"]),
    (dict(symbol=..., side=...), ["missing_symbol", "missing_side"]),
    (dict(side="\tbuy"), ["invalid_side"]),
    (dict(side="HOLD", quantity=None), ["missing_quantity", "invalid_side"]),
    (dict(symbol="  "), []),
    (dict(side=" Sell "), []),
    (dict(zzz=1), []),
])
def test_reasons(spark, change, reasons):
    assert parsed(spark, payload(**change)).reasons == reasons


def test_names_are_case_sensitive_and_numbers_become_ids(spark):
    assert parsed(spark, payload(trade_id=..., TRADE_ID="a")).trade_id is None
    assert parsed(spark, payload(trade_id=5)).trade_id == "5"
    assert math.isnan(parsed(spark, payload(price=float("nan"))).price)


@pytest.mark.parametrize("fields, wanted", [
    (dict(trade_ts=-1500), "1969-12-31 23:59:58.500"),
    (dict(trade_ts=..., timestamp="2024-03-01T10:20:30.250Z"), "2024-03-01 10:20:30.250"),
    (dict(trade_ts=..., timestamp="2024-03-01 10:20:30"), "2024-03-01 10:20:30"),
    (dict(trade_ts=..., timestamp="2024-03-01T10:20:30+02:00"), "2024-03-01 08:20:30"),
    (dict(trade_ts=..., timestamp="1700000000000"), None),
    (dict(trade_ts=..., timestamp=1700000000), None),
    (dict(trade_ts=..., timestamp="2024-13-45"), None),
    (dict(trade_ts=9_000_000_000_000_000_000), None),
    (dict(trade_ts=...), None),
])
def test_event_time(spark, fields, wanted):
    got = parsed(spark, payload(**fields)).trade_ts
    assert naive(got) == (wanted and naive(utc(wanted)))


def test_hot_time_is_floored_to_the_second(spark):
    rows = to_hot(bronze(spark, payload(trade_ts=-1500), payload(trade_ts=millis("2024-05-01 10:00:00.999"))))
    assert sorted(naive(r.trade_ts) for r in rows.collect()) == [
        naive(utc("1969-12-31 23:59:58")), naive(utc("2024-05-01 10:00:00"))]


def test_hot_keeps_the_side_and_stores_whole_rows_only(spark):
    hot = to_hot(bronze(spark, payload(side="Buy "), "{broken", payload(symbol=None), payload(trade_ts=...)))
    assert hot.count() == 4
    assert [r.side for r in storable(hot).collect()] == ["Buy "]


def test_silver_normalises(spark):
    row = to_silver(bronze(spark, payload(symbol=" A B ", side=" SELL "))).first()
    assert (row.symbol, row.side) == ("A B", "sell")


def test_blank_symbol_reaches_silver(spark):
    assert to_silver(bronze(spark, payload(symbol="   "))).first().symbol == ""


def test_the_parser_runs_once(spark):
    df = to_silver(bronze(spark, payload())).filter(F.col("price") > 1)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
