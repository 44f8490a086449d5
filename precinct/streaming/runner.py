"""Streaming queries with stable checkpoints."""

from collections.abc import Callable, Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from precinct.schema import CONSOLE_TRIGGER, DOCUMENT_TRIGGER
from precinct.sinks.documents import BatchWriter


class Result(NamedTuple):
    """A streaming frame and what is left to do with each of its micro-batches."""

    frame: DataFrame
    finish: Callable[[DataFrame], DataFrame]

    @property
    def schema(self) -> StructType:
        """Schema of the finished result."""
        return self.finish(self.frame).schema


def as_result(result: DataFrame | Result) -> Result:
    return result if isinstance(result, Result) else Result(result, lambda batch: batch)


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start(
    result: DataFrame | Result,
    name: str,
    write_batch: BatchWriter,
    checkpoints: str,
    every: str | None = DOCUMENT_TRIGGER,
) -> StreamingQuery:
    """Run ``result`` into a micro-batch writer, in append mode.

    The checkpoint folder depends on the name alone, so a restarted query goes on
    where it stopped. ``every=None`` takes what is available now and ends.
    """
    frame, finish = as_result(result)
    writer = (
        frame.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoints}/{name}")
        .foreachBatch(lambda batch, batch_id: write_batch(finish(batch), batch_id))
    )
    return _trigger(writer, every).start()


def start_console(
    results: DataFrame, name: str, checkpoints: str, every: str | None = CONSOLE_TRIGGER
) -> StreamingQuery:
    """Print new results."""
    writer = (
        results.writeStream.queryName(name)
        .outputMode("append")
        .format("console")
        .option("truncate", False)
        .option("checkpointLocation", f"{checkpoints}/{name}")
    )
    return _trigger(writer, every).start()


def start_all(
    results: Mapping[str, DataFrame | Result],
    writers: Mapping[str, BatchWriter],
    checkpoints: str,
    every: str | None = DOCUMENT_TRIGGER,
) -> dict[str, StreamingQuery]:
    """Start one query per result; if one cannot start, the others are stopped."""
    running: dict[str, StreamingQuery] = {}
    try:
        for name, result in results.items():
            running[name] = start(result, name, writers[name], checkpoints, every)
    except BaseException:
        stop_all(running.values())
        raise
    return running


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def watch(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Wait until any query ends, then stop all; the error of a failed one is raised.

    Only the given queries count, not others of the session that ended before.
    """
    queries = list(queries)
    try:
        while all(query.isActive for query in queries):
            spark.streams.resetTerminated()
            spark.streams.awaitAnyTermination(timeout=10)
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
    finally:
        stop_all(queries)


def drain(queries: Iterable[StreamingQuery]) -> None:
    """Wait for queries started with ``every=None``; the first error is raised."""
    queries = list(queries)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        stop_all(queries)
