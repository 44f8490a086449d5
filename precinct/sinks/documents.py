"""Document sinks for batches and for the micro-batches of a stream."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BatchWriter = Callable[[DataFrame, int], None]


def as_documents(frame: DataFrame, session_id: str) -> DataFrame:
    """Rows ready for a document store: NaN to null, insertion time, session.

    Arrays and timestamps stay as they are; nothing passes through the driver.
    """
    clean = {
        name: F.when(~F.isnan(name), F.col(name))
        for name, kind in frame.dtypes
        if kind in ("double", "float")
    }
    return frame.withColumns(
        {**clean, "_inserted_at": F.current_timestamp(), "_session_id": F.lit(session_id)}
    )


def file_collection(path: str, session_id: str, fmt: str = "parquet") -> BatchWriter:
    """Micro-batch writer into ``path/batch_id=N``.

    A batch that is repeated after a failure replaces its own folder, so the
    collection holds every result once. One job per batch: no counting before.
    Batch numbers belong to a checkpoint: a query that starts over without its
    checkpoint needs a new path too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        as_documents(batch, session_id).write.mode("overwrite").format(fmt).save(target)

    return write


def with_identity(frame: DataFrame, id_columns: list[str]) -> DataFrame:
    """Adds ``_id``, a digest of the columns that identify a result."""
    identity = F.to_json(F.struct(*id_columns), {"ignoreNullFields": "false"})
    return frame.withColumn("_id", F.sha2(identity, 256))


def store_collection(
    fmt: str, options: dict[str, str], id_columns: list[str], session_id: str
) -> BatchWriter:
    """Micro-batch writer through a document-store connector.

    ``_id`` is derived from the columns that identify a result, so a repeated
    batch replaces its documents if the connector upserts by ``_id``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        documents = with_identity(as_documents(batch, session_id), id_columns)
        documents.write.format(fmt).options(**options).mode("append").save()

    return write


def to_all(*writers: BatchWriter) -> BatchWriter:
    """One micro-batch to several sinks, computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for each in writers:
                each(kept, batch_id)
        finally:
            kept.unpersist()

    return write


def console(rows: int = 20) -> BatchWriter:
    """Print the first rows of a micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)

    return write
