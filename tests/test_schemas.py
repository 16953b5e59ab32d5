import pytest

from pyspark.sql import types as T
from tapeworks.schemas import QUOTE_CONTRACT, TRADE_CONTRACT, parse_contract


def test_contracts():
    assert [f.name for f in TRADE_CONTRACT.fields] == ["trade_id", "symbol", "side", "price", "quantity", "trade_ts"]
    side = TRADE_CONTRACT.fields[2]
    assert (side.kind, side.symbols, side.spark_type) == ("enum", ("BUY", "SELL"), T.StringType())
    assert QUOTE_CONTRACT.schema.simpleString() == "struct<symbol:string,bid:double,ask:double,event_ts:bigint>"


@pytest.mark.parametrize("field", [
    '{"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}}',
    '{"name": "at", "type": "long", "logicalType": "timestamp-millis"}',
])
def test_logical_type_in_either_place(field):
    (got,) = parse_contract('{"type": "record", "name": "R", "fields": [%s]}' % field).fields
    assert (got.kind, got.logical, got.nullable) == ("long", "timestamp-millis", False)


def test_nullable_union():
    (got,) = parse_contract(
        '{"type": "record", "name": "R", "fields": [{"name": "x", "type": ["null", "double"]}]}').fields
    assert got.nullable and got.spark_type == T.DoubleType()


def test_only_records():
    with pytest.raises(ValueError):
        parse_contract('{"type": "enum", "name": "E", "symbols": ["A"]}')
