"""Replaying stored messages as a stream, in order of arrival, for queries and tests."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.plans.scratch import new_folder, stored
from precinct.session import configure
from precinct.sinks.documents import file_collection
from precinct.sinks.messages import publish_files
from precinct.sources.streams import file_messages
from precinct.streaming.runner import Result, drain, start_all


def write_slices(messages: DataFrame, path: str, slices: int = 4, files: int = 8) -> list:
    """Publish messages as ``slices`` consecutive arrival ranges of ``files`` files each.

    Returns the bounds of the ranges. A stream that reads ``files`` files per
    trigger gets one slice per micro-batch. Without messages the folder is empty.
    """
    # A number, by whose bounds in the files a slice skips the others.
    timed = messages.withColumn("_moment", F.unix_micros("timestamp"))
    sent = stored(timed.repartitionByRange(slices * files, "_moment"), "sent")
    low, high = sent.agg(F.min("_moment"), F.max("_moment")).first()
    if low is None:
        publish_files(sent.drop("_moment"), path)
        return []
    bounds = [low + (high + 1 - low) * i // slices for i in range(slices + 1)]
    for begin, end in zip(bounds, bounds[1:]):
        own = sent.filter((F.col("_moment") >= begin) & (F.col("_moment") < end))
        publish_files(own.drop("_moment").repartition(files), path)
    return bounds


def publish_slice(messages: DataFrame, path: str, begin: int, end: int, files: int) -> None:
    moment = F.unix_micros("timestamp")
    publish_files(messages.filter((moment >= begin) & (moment < end)).repartition(files), path)


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session of its own for streams, with a partition for each of the machine's slots.

    A query keeps the number of partitions of its first batch, and each of them
    is a state store.
    """
    own = configure(spark.newSession())
    own.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return own


def run_to_end(
    spark: SparkSession,
    source: str,
    build: Callable[[DataFrame], dict[str, DataFrame | Result]],
    files: int = 8,
) -> dict[str, DataFrame]:
    """Run every result of ``build`` over the published messages until they are used up."""
    messages = file_messages(streaming_session(spark), source, files_per_trigger=files)
    return collections_of(spark, build(messages))


def collections_of(
    spark: SparkSession, results: dict[str, DataFrame | Result]
) -> dict[str, DataFrame]:
    """Run all results at the same time, each with its own checkpoint, to the end.

    Returns the stored collections without the metadata columns; one that got no
    batch is empty.
    """
    base = new_folder(spark, "stream")
    writers = {name: file_collection(f"{base}/{name}", "replay") for name in results}
    drain(start_all(results, writers, f"{base}/checkpoints", every=None).values())
    found = {}
    for name, result in results.items():
        spark.createDataFrame([], result.schema).write.mode("ignore").parquet(
            f"{base}/{name}/batch_id=-1"
        )
        stored_rows = spark.read.schema(result.schema).parquet(f"{base}/{name}")
        found[name] = stored_rows.select(result.schema.fieldNames())
    return found
