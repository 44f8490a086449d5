"""Raw text records to typed, enriched, located incidents.

All steps are narrow projections and one filter, so the whole chain is a single
stage over the scan and reads only the ten columns it needs.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.functions import calendar, geo, text
from precinct.schema import CURATED, RAW_TO_CURATED


def select_renamed(raw: DataFrame) -> DataFrame:
    return raw.select([F.col(f"`{name}`").alias(alias) for name, alias in RAW_TO_CURATED.items()])


def typed(records: DataFrame) -> DataFrame:
    return records.withColumns(
        {
            "crime_id": text.parse_long(F.col("crime_id")),
            "date": text.parse_timestamp(F.col("date")),
            "arrest": text.parse_boolean(F.col("arrest")),
            "domestic": text.parse_boolean(F.col("domestic")),
            "latitude": text.parse_double(F.col("latitude")),
            "longitude": text.parse_double(F.col("longitude")),
        }
    )


def with_calendar(records: DataFrame, moment: str = "date") -> DataFrame:
    return records.withColumns(
        {
            "day_of_week": calendar.weekday_name(F.col(moment)),
            "month": F.month(moment),
            "year": F.year(moment),
        }
    )


def with_season(records: DataFrame) -> DataFrame:
    return records.withColumn("season", calendar.season(F.col("month")))


def located(records: DataFrame) -> DataFrame:
    return records.filter(geo.has_coordinates(F.col("latitude"), F.col("longitude")))


def curate(raw: DataFrame) -> DataFrame:
    """The whole chain; rows without a readable date stay (season ``Unknown``)."""
    steps = with_season(with_calendar(located(typed(select_renamed(raw)))))
    return steps.select(CURATED.fieldNames())
