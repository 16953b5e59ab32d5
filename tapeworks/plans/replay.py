"""Running the streams over a finite table: it is written as files and read back as a stream."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks.session import workspace
from tapeworks.sources.envelope import read_envelope_files

Start = Callable[[DataFrame], StreamingQuery]


def replay_shuffled(envelope: DataFrame, start: Start, batches: int = 4) -> None:
    """One run in several micro-batches, records in no order of time."""
    spark = envelope.sparkSession
    source = workspace(spark, "stream-source")
    files = max(2 * batches, spark.sparkContext.defaultParallelism)
    envelope.repartition(files, "partition", "offset").write.parquet(source)
    per_batch = str(math.ceil(files / batches))
    start(read_envelope_files(spark, source, stream=True, maxFilesPerTrigger=per_batch)).awaitTermination()


def replay_in_order(envelope: DataFrame, start: Start, slices: int = 3) -> None:
    """One run per slice of time, each going on from the checkpoint of the last."""
    spark: SparkSession = envelope.sparkSession
    source = workspace(spark, "stream-source")
    first, last = envelope.agg(F.min("timestamp"), F.max("timestamp")).select(
        *[F.unix_micros(c) for c in ("min(timestamp)", "max(timestamp)")]
    ).first()
    width = max((last - first) // slices + 1, 1)
    number = F.floor((F.unix_micros("timestamp") - first) / width)
    for i in range(slices):
        envelope.filter(number == i).write.mode("append").parquet(source)
        start(read_envelope_files(spark, source, stream=True)).awaitTermination()
