"""Dropping repeated trades on a stream."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY = "dedupe_key"


def _few_of_each(key: str, ts: str) -> Callable:
    """Of the rows of a key in an Arrow batch, the first and, if that is another, the first of the newest time; and all
    rows without a key."""
    def run(batches):
        for batch in batches:
            codes = batch.column(key).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            if len(codes) > codes.max(initial=-1) + 1:
                times = batch.column(ts).cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
                _, first = np.unique(codes, return_index=True)
                order = np.lexsort((-np.arange(len(codes)), times, codes))
                newest = order[np.append(np.flatnonzero(np.diff(codes[order])), len(order) - 1)]
                kept = codes < 0
                kept[first] = kept[newest] = True
                batch = batch.filter(pa.array(kept))
            yield batch
    return run


def drop_repeats(
    trades: DataFrame, delay: str, ts: str = "trade_ts", key: str = "trade_id", split: int = 8
) -> DataFrame:
    """Keep the first arrival of each key within the watermark.

    Rows without a key are repeats of nothing: their place in the topic stands in for it, so that only the same
    record delivered again is dropped. Before the shuffle, every task drops repeats inside its Arrow batches, so that
    of a key sent over and over the one task that holds its state sees at most two rows a batch: the first, and one of
    its newest time, by which the watermark stands as high as without this. State holds a key once. ``split=1`` leaves
    the first step out, for feeds without hot keys.
    """
    own_place = F.concat_ws(":", F.lit("#"), "kafka_partition", "kafka_offset")
    few = trades.mapInArrow(_few_of_each(key, ts), trades.schema) if split > 1 else trades
    marked = few.withWatermark(ts, delay).withColumn(_KEY, F.coalesce(F.col(key), own_place))
    return marked.dropDuplicatesWithinWatermark([_KEY]).drop(_KEY)
