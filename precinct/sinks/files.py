"""File sinks."""

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_curated(
    curated: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace the curated table at ``path``.

    Partitioned output is rebalanced on the partition columns first: each
    partition gets files of the advisory size, a partition that holds most rows
    is split over many tasks, and no task opens files of every partition.
    """
    if partition_by:
        curated = curated.hint("rebalance", *partition_by)
    writer = curated.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def preview(frame: DataFrame, rows: int = 20) -> None:
    """Print the first rows; reads no more than it needs to."""
    frame.show(rows, truncate=False)
