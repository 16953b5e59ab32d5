"""Literal rows for the tests."""

import json
from datetime import datetime, timezone

from tapeworks.schemas import BRONZE, ENVELOPE, HOT_TRADE, QUOTE, SILVER


def utc(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def naive(moment):
    """What collect() returns for a moment, as UTC without a zone."""
    return None if moment is None else moment.astimezone(timezone.utc).replace(tzinfo=None)


def millis(text):
    return round(utc(text).timestamp() * 1000)


def payload(**fields):
    base = {"trade_id": "a", "symbol": "AAPL", "side": "BUY", "price": 10.5, "quantity": 2.0,
            "trade_ts": millis("2024-05-01 10:00:00.250")}
    base.update(fields)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def bronze(spark, *values, ts="2024-05-01 10:00:01", ingested="2024-05-01 10:00:02"):
    """Bronze rows; a value is the payload, or (payload, source time)."""
    rows = []
    for i, value in enumerate(values):
        raw, at = value if isinstance(value, tuple) else (value, ts)
        rows.append(("k", raw, "trades_raw", i % 3, i, at and utc(at), utc(ingested)))
    return spark.createDataFrame(rows, BRONZE)


def envelope(spark, *values, topic="trades_raw", ts="2024-05-01 10:00:01", first_offset=0):
    rows = [(b"k", v.encode(), topic, i % 3, first_offset + i, utc(ts)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def silver(spark, *rows):
    """(trade_id, symbol, side, price, quantity, time) rows; the time serves as all three."""
    full = [(i, s, p, q, side, t and utc(t), t and utc(t), t and utc(t)) for i, s, side, p, q, t in rows]
    return spark.createDataFrame(full, SILVER)


def trades(spark, *rows):
    """(trade_id, symbol, price, quantity, time) rows of the hot schema."""
    return spark.createDataFrame([(i, s, "BUY", p, q, t and utc(t)) for i, s, p, q, t in rows], HOT_TRADE)


def quotes(spark, *rows):
    return spark.createDataFrame([(s, b, a, t and utc(t)) for s, b, a, t in rows], QUOTE)


def final_plan(df):
    """The plan before execution, as text."""
    return df._jdf.queryExecution().executedPlan().toString()
