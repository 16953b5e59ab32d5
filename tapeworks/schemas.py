"""Table schemas, and the loader that turns an Avro record contract into Spark types."""

from __future__ import annotations

import json
from dataclasses import dataclass
from importlib import resources
from pathlib import Path

from pyspark.sql import types as T

ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

BRONZE = T.StructType([
    T.StructField("kafka_key", T.StringType()),
    T.StructField("raw_value", T.StringType()),
    T.StructField("kafka_topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("source_ts", T.TimestampType()),
    T.StructField("ingestion_time", T.TimestampType()),
])

HOT_TRADE = T.StructType([
    T.StructField("trade_id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("side", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("trade_ts", T.TimestampType()),
])

SILVER = T.StructType([
    T.StructField("trade_id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("side", T.StringType()),
    T.StructField("trade_ts", T.TimestampType()),
    T.StructField("source_ts", T.TimestampType()),
    T.StructField("ingestion_time", T.TimestampType()),
])

QUOTE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("ask", T.DoubleType()),
    T.StructField("event_ts", T.TimestampType()),
])

# Avro primitive name -> Spark type.
_PRIMITIVES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
    "enum": T.StringType(),
}


@dataclass(frozen=True)
class ContractField:
    name: str
    kind: str
    nullable: bool = False
    symbols: tuple[str, ...] = ()
    logical: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        """The type the value has inside the payload; epoch millis stay a number."""
        return _PRIMITIVES[self.kind]


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[ContractField, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])


def _contract_field(entry: dict) -> ContractField:
    declared, nullable = entry["type"], False
    if isinstance(declared, list):
        nullable = "null" in declared
        (declared,) = [t for t in declared if t != "null"]
    detail = declared if isinstance(declared, dict) else {"type": declared}
    # The logical type is honoured inside the type object and beside it on the field.
    return ContractField(
        name=entry["name"],
        kind=detail["type"],
        nullable=nullable,
        symbols=tuple(detail.get("symbols", ())),
        logical=detail.get("logicalType", entry.get("logicalType")),
    )


def parse_contract(text: str) -> Contract:
    record = json.loads(text)
    if record.get("type") != "record":
        raise ValueError("a contract must be an Avro record")
    return Contract(record["name"], tuple(_contract_field(f) for f in record["fields"]))


def load_contract(name: str) -> Contract:
    """``trade`` or ``quote``, or the path of any other contract file."""
    own = resources.files("tapeworks").joinpath("contracts", f"{name}.avsc")
    return parse_contract(own.read_text() if own.is_file() else Path(name).read_text())


TRADE_CONTRACT = load_contract("trade")
QUOTE_CONTRACT = load_contract("quote")

# Older producers send the event time as an ISO string called ``timestamp``.
TRADE_PAYLOAD = T.StructType(TRADE_CONTRACT.schema.fields + [T.StructField("timestamp", T.StringType())])
