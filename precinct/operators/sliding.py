"""Sliding windows built from panes, for the windowed transformations.

A sliding window is a run of ``length / slide`` panes as wide as the slide. In a
batch, rows are reduced to panes before anything is copied into windows, so raw
rows are shuffled once, after the map-side combine, and never multiplied by the
number of windows they fall into.

A stream puts rows into the sliding windows directly: a late row may still belong
to the open ones among its windows while its pane has closed.

Lengths are whole minutes; the slide must divide the length.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stream_windows(rows: DataFrame, event_time: str, length: int, slide: int) -> DataFrame:
    """Rows once for each ``window`` they are in.

    Ingested rows carry a ``watermark``; windows that had ended by then miss them.
    """
    window = F.window(event_time, f"{length} minutes", f"{slide} minutes")
    rows = rows.withColumn("window", window)
    if "watermark" not in rows.columns:
        return rows
    open_then = F.col("window.end") > F.col("watermark")
    return rows.filter(F.col("watermark").isNull() | open_then)


def with_watermark(rows: DataFrame) -> list[str]:
    """The column with the watermark of ingested rows, if they have one."""
    return [name for name in rows.columns if name == "watermark"]


def missed_windows(event_time: Column, watermark: Column, length: int, slide: int) -> Column:
    """How many windows of a row had ended by ``watermark``; null without one of the two."""
    base = F.floor(F.unix_timestamp(event_time) / (slide * 60)) * (slide * 60)
    # Its windows end 1, 2, ... ``length / slide`` slides after that.
    ended = F.floor((F.unix_timestamp(watermark) - base) / (slide * 60))
    bounded = F.greatest(F.lit(0), F.least(F.lit(length // slide), ended))
    return F.when(ended.isNotNull(), bounded.cast("int"))


def _panes(rows, event_time, length, slide, keys, sums) -> DataFrame:
    """Sums per (``pane``, keys); a pane is numbered from the epoch.

    Rows without a time belong to no window, as on a stream.
    """
    if length % slide:
        raise ValueError("the slide must divide the window length")
    number = F.floor(F.unix_timestamp(event_time) / (slide * 60)).alias("pane")
    timed = rows.filter(F.col(event_time).isNotNull())
    return timed.groupBy(number, *keys).agg(*_named(sums))


def _named(sums: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in sums.items()]


def _window(first_pane: Column, length: int, slide: int) -> Column:
    """Bounds of the window that begins with the given pane."""
    start = first_pane * (slide * 60)
    return F.struct(
        F.timestamp_seconds(start).alias("start"),
        F.timestamp_seconds(start + length * 60).alias("end"),
    ).alias("window")


def sliding_totals(
    rows: DataFrame,
    event_time: str,
    length: int,
    slide: int,
    keys: Sequence[str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """One row of counts and sums per (``window``, keys)."""
    if rows.isStreaming:
        inside = stream_windows(rows, event_time, length, slide)
        return inside.groupBy("window", *keys).agg(*_named(sums))
    panes = _panes(rows, event_time, length, slide, keys, sums)
    back = F.explode(F.lit(list(range(length // slide)))).alias("back")
    return (
        panes.select("*", back)
        .groupBy((F.col("pane") - F.col("back")).alias("first_pane"), *keys)
        .agg(*[F.sum(name).alias(name) for name in sums])
        .select(_window(F.col("first_pane"), length, slide), *keys, *sums)
    )


def gathered(counts: DataFrame, keys: Sequence[str], category: str) -> DataFrame:
    """One row per (``window``, keys) with ``entries``, from counts per category as well."""
    rest = [name for name in counts.columns if name not in ("window", *keys, category)]
    entry = F.struct(category, *rest)
    return counts.groupBy("window", *keys).agg(F.collect_list(entry).alias("entries"))


def sliding_entries(
    rows: DataFrame,
    event_time: str,
    length: int,
    slide: int,
    keys: Sequence[str],
    category: str | None,
    sums: Mapping[str, Column],
    chunk: int | None = None,
) -> DataFrame:
    """One row per (``window``, keys) with ``entries``: the counts and sums per category.

    A category may have several entries, one per pane; the caller adds them up.
    Without a category (batches only) there is one entry per pane.
    Only counters are ever collected, never rows.

    Batch: the panes of a key are brought together in chunks of ``chunk``
    consecutive windows (four window lengths by default). A pane is copied only
    where its windows reach over the end of a chunk, and the windows are cut out
    of the collected panes in place, so the second shuffle carries about as many
    rows as there are panes, and a group is no larger than the counters of one
    chunk however many rows the key has.

    Stream: counters per (window, keys, category) are kept as state and put
    together when their window closes.
    """
    if rows.isStreaming:
        counts = sliding_totals(rows, event_time, length, slide, [*keys, category], sums)
        return gathered(counts, keys, category)

    span = length // slide
    chunk = chunk or 4 * span
    within = [category] if category else []
    panes = _panes(rows, event_time, length, slide, [*keys, *within], sums)
    pane = F.col("pane")
    chunks = F.sequence(F.floor((pane - (span - 1)) / chunk), F.floor(pane / chunk))
    collected = (
        panes.select("*", F.explode(chunks).alias("chunk"))
        .groupBy(*keys, "chunk")
        .agg(F.collect_list(F.struct("pane", *within, *sums)).alias("collected"))
    )

    def window_from(first: Column) -> Column:
        inside = F.filter("collected", lambda e: e["pane"].between(first, first + (span - 1)))
        return F.struct(first.alias("first_pane"), inside.alias("entries"))

    begin = F.col("chunk") * chunk
    windows = F.transform(F.sequence(begin, begin + (chunk - 1)), window_from)
    occupied = F.filter(windows, lambda w: F.size(w["entries"]) > 0)
    return collected.select(*keys, F.inline(occupied)).select(
        _window(F.col("first_pane"), length, slide), *keys, "entries"
    )
