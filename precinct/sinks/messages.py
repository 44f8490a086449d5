"""Publishing messages to a topic or to files that stand for one."""

from pyspark.sql import DataFrame


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Topic sink (needs the Kafka connector); the broker sets the arrival time."""
    writer = messages.select("key", "value").write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_files(messages: DataFrame, path: str, fmt: str = "parquet") -> None:
    messages.write.mode("append").format(fmt).save(path)
