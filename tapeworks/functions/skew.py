"""Joins and groups in which a few keys hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more than a ten-thousandth of all rows is hot; so there can be no more than ten thousand hot keys.
HOT_KEYS_AT_MOST = 10_000
# A key with no more rows than this is never hot.
HOT_ROWS = 1_000_000


def hot_limit(counts: DataFrame, rows: str, floor: int = HOT_ROWS) -> Column:
    """The number of rows above which a key is hot, from a table with the row count of every key."""
    share = counts.select(F.sum(rows) / F.lit(HOT_KEYS_AT_MOST)).scalar()
    return F.greatest(F.lit(floor).cast("double"), share)


def dealt(columns: Sequence[str], hands: Column) -> Column:
    """A number below ``hands`` for each row; copies of a row differ by the task that read them."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), hands).cast("int")


def left_lookup(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], weight: str, floor: int = HOT_ROWS
) -> DataFrame:
    """Left join with a table that has one row per key; its other columns come as the struct ``found``.

    ``weight`` is the column of ``lookup`` that says how many rows have the key. Entries of hot keys are
    broadcast, ten thousand at most; all others are joined by a shuffle. Rows that are already matched, or have
    no key, are dealt over the tasks of that shuffle instead of meeting in the task of their key.
    """
    limit = hot_limit(lookup, weight, floor)
    found = F.struct(*[c for c in lookup.columns if c not in keys])
    is_hot = F.col(weight) > limit
    hot = lookup.filter(is_hot).select(*keys, found.alias("found_hot"))
    # Always 0, but not a literal: with one the optimizer would join by the keys alone.
    zero = F.when(F.col(weight) >= 0, F.lit(0)).otherwise(F.lit(-1))
    rest = lookup.filter(~is_hot).select(*keys, found.alias("found"), zero.alias("deal"))

    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    looked_up = rows.join(F.broadcast(hot), list(keys), "left")
    settled = F.col("found_hot").isNotNull() | no_key
    own = dealt(rows.columns, F.lit(HOT_KEYS_AT_MOST)) + 1
    return (
        looked_up.withColumn("deal", F.when(settled, own).otherwise(F.lit(0)))
        .join(rest, [*keys, "deal"], "left")
        .select(*rows.columns, F.coalesce("found_hot", "found").alias("found"))
    )
