"""Unbounded sources, all with the message layout of ``schema.ENVELOPE``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.schema import ENVELOPE

# All messages from the first on; if some are gone before they were read, the query fails.
KAFKA_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "true"}


def kafka_options(servers: str, topic: str, **overrides: str) -> dict[str, str]:
    """Options of the topic source; use ``maxOffsetsPerTrigger`` and
    ``minPartitions`` to size micro-batches and tasks at volume. Only a caller
    who accepts lost messages sets ``failOnDataLoss="false"``."""
    return {**KAFKA_OPTIONS, "kafka.bootstrap.servers": servers, "subscribe": topic, **overrides}


def kafka_messages(spark: SparkSession, servers: str, topic: str, **overrides: str) -> DataFrame:
    """Topic source (needs the Kafka connector on the class path)."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **overrides))
    return stream.load().select(
        F.col("key").cast("string"), F.col("value").cast("string"), "timestamp"
    )


def file_messages(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Messages from files that appear in a folder, oldest first."""
    reader = spark.readStream.schema(ENVELOPE).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
