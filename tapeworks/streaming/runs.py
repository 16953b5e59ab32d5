"""Starting streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tapeworks.sinks.files import merge_batches

BatchStep = Callable[[DataFrame, int], None]

# A record waits for its batch and the one before it; two seconds leave most of five for the work.
DEFAULT_TRIGGER = {"processingTime": "2 seconds"}
CATCH_UP = {"availableNow": True}


def start_batches(
    stream: DataFrame, step: BatchStep, checkpoint: str, trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Call ``step`` for every micro-batch. An error in it fails the batch, which is tried again on restart."""
    return (
        stream.writeStream.foreachBatch(step)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )


# So many batches, or merged ones, are brought together at a time.
TIER = 10


def in_tiers(step: BatchStep, path: str, by: str | None = None, merge: Callable[[DataFrame], DataFrame] | None = None,
             tier: int = TIER) -> BatchStep:
    """``step``, before which the folders that it has written for finished batches are merged, ten into one.

    Ten of the merged ones become one in turn, and so on: what a reader lists grows with the number of digits of the
    batches, and a row is written again once for each digit. The batch at hand is never among them, so that it may be
    repeated.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        width = tier
        while batch_id and batch_id % width == 0:
            merge_batches(batch.sparkSession, path, batch_id - width, batch_id - 1, by, merge)
            width *= tier
        step(batch, batch_id)
    return run


def start_files(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to Parquet files; the sink's own log makes each batch appear once."""
    with _uncounted_state(stream.sparkSession):
        return (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER))
            .start()
        )


@contextmanager
def _uncounted_state(spark: SparkSession) -> Iterator[None]:
    """A stream started here does not count the rows of its state, which costs a second lookup for each one put there."""
    name = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
