"""The streaming job: messages are ingested once, five transformations read the result."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from precinct.functions import geo
from precinct.operators.correlation import domestic_correlation
from precinct.operators.escalation import violence_escalation
from precinct.operators.hotspots import hotspot_counts, hotspots_from_counts
from precinct.operators.patterns import match_patterns
from precinct.operators.sliding import missed_windows
from precinct.operators.temporal import temporal_patterns
from precinct.schema import WATERMARK_DELAY
from precinct.streaming.ingest import Busy, Ingest
from precinct.streaming.runner import Result, start

# --- fixed values: collection names, with the columns that identify a result ---
COLLECTIONS = {
    "stream_crime_hotspots": ["window_start", "geo_grid"],
    "stream_violence_escalation": ["period_start", "geo_zone"],
    "stream_domestic_correlation": ["d_crime_id", "nd_crime_id"],
    "stream_pattern_analysis": ["crime_id", "event_time", "pattern_location"],
    "stream_temporal_patterns": ["analysis_start", "primary_type", "hour_of_day", "is_weekend"],
}


def _late_for(length: int, slide: int, wanted: Column | None = None) -> Callable[[], Column]:
    def windows() -> Column:
        missed = missed_windows(F.col("event_time"), F.col("watermark"), length, slide)
        return missed if wanted is None else F.when(wanted, missed)

    return windows


def _late_for_pairs() -> Column:
    behind = F.col("event_time") <= F.col("watermark")
    return F.when(geo.has_coordinates(F.col("latitude"), F.col("longitude")) & behind, 1)


def lateness() -> dict[str, Callable[[], Column]]:
    """By collection, the windows that an ingested row misses; pattern matching waits for none."""
    located = geo.has_coordinates(F.col("latitude"), F.col("longitude"))
    return {
        "stream_crime_hotspots": _late_for(5, 1, located),
        "stream_violence_escalation": _late_for(10, 2, F.col("is_violent")),
        "stream_domestic_correlation": _late_for_pairs,
        "stream_temporal_patterns": _late_for(15, 5),
    }


def ingest(path: str, busy: Busy = Busy()) -> Ingest:
    """The ingest for the transformations of this module."""
    return Ingest(path, int(WATERMARK_DELAY.split()[0]), lateness(), busy)


def store_incidents(
    messages: DataFrame, path: str, checkpoints: str, every: str | None, busy: Busy = Busy()
) -> tuple[StreamingQuery, StructType]:
    """Start the query that ingests messages below ``path``; also the schema of accepted rows."""
    target = ingest(path, busy)
    target.prepare(messages.sparkSession)
    query = start(messages, "stream_incidents", target.write, checkpoints, every)
    return query, target.schema(messages.sparkSession)


def stored_incidents(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Accepted incidents of ``path`` as a stream, with the watermark on their arrival time."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withWatermark("event_time", WATERMARK_DELAY)


def matched(
    enriched: DataFrame, patterns: DataFrame | Callable[[SparkSession], DataFrame]
) -> DataFrame | Result:
    """Incidents matched with one table of patterns, or with the current one of each micro-batch."""
    if isinstance(patterns, DataFrame):
        return match_patterns(enriched, patterns)
    return Result(enriched, lambda batch: match_patterns(batch, patterns(batch.sparkSession)))


def transformations(
    enriched: DataFrame,
    patterns: DataFrame | Callable[[SparkSession], DataFrame],
    correlation_salts: int | None = None,
    types: str = "counts",
) -> dict[str, DataFrame | Result]:
    """Streaming results of a stream of incidents by collection name.

    ``patterns`` is a stored table, or a function that finds the current one: it
    is asked in every micro-batch, so that a rebuild is used from the next one on.

    ``correlation_salts`` splits the correlation state of every cell and time slot
    alike, instead of the busy cells that the ingest found. ``types`` is the
    form in which hotspots give their types (see ``hotspots``).
    """

    def dense(counts: DataFrame) -> DataFrame:
        return hotspots_from_counts(counts, types=types)

    return {
        "stream_crime_hotspots": Result(hotspot_counts(enriched), dense),
        "stream_violence_escalation": violence_escalation(enriched),
        "stream_domestic_correlation": domestic_correlation(enriched, salts=correlation_salts),
        "stream_pattern_analysis": matched(enriched, patterns),
        "stream_temporal_patterns": temporal_patterns(enriched),
    }
