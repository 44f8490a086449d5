"""Helpers that several corpus operators share."""

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator
from math import isqrt
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The white space that separates words.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Rows of an Arrow batch: the JVM and the worker each hold one per task.
BATCH_ROWS = 2_048
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_text(docs: DataFrame, text: str = "text") -> Column:
    """The text of a document; null counts as empty."""
    return F.coalesce(docs[text], F.lit(""))


def word_array(text: Column) -> Column:
    """Words of ``text``, in order; none if it is null or blank."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.split(trimmed, r"[\x20\x09-\x0D]+")
    return F.when(F.octet_length(trimmed) > 0, words).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """Number of words of ``text`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: str | Column, parts: int, remainder: int) -> Column:
    """Whether crc32 of the id, as text, leaves ``remainder``; a null id is not held out."""
    crc = F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id)
    return F.coalesce(crc % parts == remainder, F.lit(False))


def window(text: str, size: int, row_id: str) -> Column:
    """``size`` characters of a text from a place that a hash of the id draws, or all of it."""
    room = F.greatest(F.char_length(text) - F.lit(size) + 1, F.lit(1))
    begin = F.pmod(F.xxhash64(F.lit("window"), row_id), room) + 1
    return F.substr(F.col(text), begin.cast("int"), F.lit(size))


def importable(frame: DataFrame) -> DataFrame:
    """``frame``, after Python workers were told where this library lies.

    They need it where the driver has the library by ``sys.path`` only, as in local runs; on
    a cluster it is shipped with the job. Workers get batches of ``BATCH_ROWS`` rows at most.
    """
    conf = frame.sparkSession.conf
    if not 0 < int(conf.get(_ARROW_ROWS)) <= BATCH_ROWS:
        conf.set(_ARROW_ROWS, BATCH_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    environment = frame.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return frame


def free_name(frame: DataFrame, wish: str) -> str:
    """``wish``, or with underscores behind it if the frame has such a column."""
    taken = {name.lower() for name in frame.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def running(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    amounts: dict[str, Column],
    rows: int,
    least: int = 2_000,
) -> DataFrame:
    """Adds, per key, the sum of each amount over all rows before this one.

    The order is a fixed hash order, not a sort: rows are dealt into chunks by a hash of
    ``order``, chunk totals are added up first, and only chunks (``least`` rows, or the square
    root of ``rows``) are sorted in one task, so a key may hold any share of the rows.
    Keys must not be null, and rows that ``order`` does not tell apart must be alike.
    """
    chunks = max(1, rows // max(least, isqrt(rows)))
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), *order), F.lit(chunks)).cast("int")
    dealt = frame.withColumn("_chunk", chunk)
    totals = dealt.groupBy(*keys, "_chunk").agg(
        *(F.sum(amount).alias(f"_all_{name}") for name, amount in amounts.items())
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        *keys,
        "_chunk",
        *(F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_base_{n}") for n in amounts),
    )
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(F.xxhash64(F.lit("row"), *order), *order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = dealt.withColumns(
        {f"_here_{n}": F.coalesce(F.sum(a).over(inside), F.lit(0)) for n, a in amounts.items()}
    )
    return local.join(bases, [*keys, "_chunk"]).select(
        *frame.columns,
        *((F.col(f"_base_{n}") + F.col(f"_here_{n}")).cast("long").alias(n) for n in amounts),
    )


_kept: dict = {}


def worker_table(key, build: Callable):
    """What ``build()`` makes, kept by this worker for its later tasks.

    One at a time: workers outlive a stage, and the tables of an earlier one would stay.
    ``worker_table(None, ...)`` only drops what is there.
    """
    if key not in _kept:
        if _kept:
            _kept.clear()
            give_back()
        if key is not None:
            _kept[key] = build()
    return _kept.get(key)


def give_back() -> None:
    """Return what this worker has freed to the system: it stays idle while other stages run."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in runs of ``rows`` rows, so that no more of them are held as objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def pieces(
    batches: Iterable[pa.RecordBatch], text: str, most_chars: int
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cuts Arrow batches into runs of rows with about ``most_chars`` bytes of text.

    A row is never divided, so one long text is a run of its own. Null texts come as "".
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = [len(x) if x is not None else 0 for x in (column.cast(pa.binary()).to_pylist())]
        begin, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > most_chars:
                part = batch.slice(begin, row - begin)
                yield part, texts_of(part, text)
                begin, held = row, 0
            held += size
        if begin < batch.num_rows:
            part = batch.slice(begin)
            yield part, texts_of(part, text)


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    column = batch.column(batch.schema.get_field_index(text))
    return [x if x is not None else "" for x in column.to_pylist()]
