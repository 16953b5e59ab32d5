"""Reading event envelopes: a broker topic, or files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.schemas import ENVELOPE

# Stream defaults for a topic: start at the newest records, go on when the broker has dropped offsets.
TOPIC_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def read_topic(spark: SparkSession, servers: str, topic: str, *, stream: bool = True, **options: str) -> DataFrame:
    """Subscribe to topics (comma separated), or read their present content once with ``stream=False``.

    ``minPartitions`` splits large topic partitions over more tasks; ``maxOffsetsPerTrigger`` bounds a
    micro-batch. Needs the Kafka connector on the classpath.
    """
    defaults = TOPIC_DEFAULTS if stream else {"failOnDataLoss": TOPIC_DEFAULTS["failOnDataLoss"]}
    reader = spark.readStream if stream else spark.read
    return (
        reader.format("kafka")
        .options(**{**defaults, **options})
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )


def read_envelope_files(
    spark: SparkSession, path: str, *, fmt: str = "parquet", stream: bool = False, **options: str
) -> DataFrame:
    """The same envelope from files, as a table or as a stream of files."""
    reader = spark.readStream if stream else spark.read
    return reader.format(fmt).schema(ENVELOPE).options(**options).load(path)


def to_bronze(envelope: DataFrame) -> DataFrame:
    """Raw records with readable names and the time of ingestion.

    On a stream the ingestion time is the batch's own time. It is kept in the offset log, so a batch that is
    tried again gets the same value.
    """
    return envelope.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("source_ts"),
        F.current_timestamp().alias("ingestion_time"),
    )
