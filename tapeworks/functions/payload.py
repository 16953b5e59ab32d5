"""JSON payload parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_payload(
    df: DataFrame, schema: T.StructType, value: str = "raw_value", keep: Sequence[str] = ()
) -> DataFrame:
    """The fields of a JSON payload as columns, beside the columns to ``keep``; the parser runs once per row.

    ``inline`` of a one-element array is used instead of ``select("data.*")``. Later filters on the parsed
    fields cannot move below a generator, so Catalyst does not repeat ``from_json`` for each field a filter
    names. Rows that do not parse stay, with NULL in every field.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(F.col(value).cast("string"), schema))))
