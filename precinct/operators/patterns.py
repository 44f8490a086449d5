"""Incidents matched against historical patterns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.operators.lookup import lookup_join

PATTERN_KEYS = ("primary_type", "hour_pattern", "dow_pattern")


def historical_patterns(
    history: DataFrame, moment: str = "crime_date", per_location: bool = True
) -> DataFrame:
    """Typical place and frequency per type, hour and weekday (1 = Sunday).

    ``per_location`` keeps one pattern per location, so that matching on type,
    hour and weekday repeats an incident for every location with a pattern;
    without it an incident matches at most one pattern.
    """
    location = ["location_description"] if per_location else []
    return history.groupBy(
        "primary_type",
        *location,
        F.hour(moment).alias("hour_pattern"),
        F.dayofweek(moment).alias("dow_pattern"),
    ).agg(
        F.avg("latitude").alias("typical_lat"),
        F.avg("longitude").alias("typical_lon"),
        F.count("*").alias("historical_frequency"),
    )


def match_patterns(
    incidents: DataFrame,
    patterns: DataFrame,
    event_time: str = "event_time",
    salts: int = 1,
    strategy: str | None = None,
) -> DataFrame:
    """Every incident with the patterns of its type at its arrival hour and weekday.

    ``pattern_location`` tells the patterns of an incident apart; it is null for
    patterns of any location. ``salts`` and ``strategy`` are those of
    ``lookup_join``. ``patterns`` should be a stored table: Spark then
    knows its size, and a stream reads it in every micro-batch.
    """
    keyed = incidents.select(
        "crime_id",
        "crime_date",
        "primary_type",
        "location_description",
        F.col(event_time).alias("event_time"),
        F.hour(event_time).alias("hour_pattern"),
        F.dayofweek(event_time).alias("dow_pattern"),
    )
    place = F.lit(None).cast("string")
    if "location_description" in patterns.columns:
        place = F.col("location_description")
    lookup = patterns.select(
        *PATTERN_KEYS, place.alias("pattern_location"), "historical_frequency"
    )
    row_id = ("crime_id", "event_time")
    matched = lookup_join(keyed, lookup, PATTERN_KEYS, row_id, salts, strategy)
    found = F.col("historical_frequency").isNotNull()
    return matched.select(
        "crime_id",
        "crime_date",
        "primary_type",
        "location_description",
        "pattern_location",
        found.alias("pattern_match"),
        F.when(found, 0.0).otherwise(1.0).alias("anomaly_score"),
        "historical_frequency",
        "event_time",
    )
