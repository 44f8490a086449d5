"""The ten batch reports over curated incidents.

Each report accepts the curated incidents themselves or the much smaller
``summary`` of them, which carries a row count per combination of the report
columns. Publishing all reports from one stored summary scans the incidents once
for the nine category reports and once for the geographic one. All sorts end
with the group key, so order is total and no sort key can hold most rows.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.schema import VIOLENT_TYPES

ROWS = "row_total"
SUMMARY_KEYS = (
    "year",
    "month",
    "day_of_week",
    "season",
    "primary_type",
    "location_description",
    "arrest",
    "domestic",
)


def summary(curated: DataFrame) -> DataFrame:
    """Row count per combination of all columns the category reports use."""
    return curated.groupBy(*SUMMARY_KEYS).agg(F.count("*").alias(ROWS))


def _rows(source: DataFrame) -> Column:
    return F.sum(ROWS) if ROWS in source.columns else F.count("*")


def _totals(source: DataFrame, *keys: str, name: str = "total_crimes") -> DataFrame:
    return source.groupBy(*keys).agg(_rows(source).alias(name))


def _leading(totals: DataFrame, group: str) -> DataFrame:
    """Largest total per group; equal totals go to the first type by name.

    An aggregate that is combined before the shuffle: no group is sorted.
    """
    order = F.struct((-F.col("total_crimes")).alias("less"), F.col("primary_type").alias("type"))
    best = F.min_by(F.struct("primary_type", "total_crimes"), order).alias("best")
    found = totals.groupBy(group).agg(best).select(group, "best.*", F.lit(1).alias("rank"))
    return found.orderBy(group)


def by_weekday(source: DataFrame) -> DataFrame:
    return _totals(source, "day_of_week").orderBy(F.desc("total_crimes"), "day_of_week")


def leading_type_per_year(source: DataFrame) -> DataFrame:
    return _leading(_totals(source, "year", "primary_type"), "year")


def by_location(source: DataFrame) -> DataFrame:
    return _totals(source, "location_description").orderBy(
        F.desc("total_crimes"), "location_description"
    )


def by_type_and_arrest(source: DataFrame) -> DataFrame:
    return _totals(source, "primary_type", "arrest").orderBy("primary_type", "arrest")


def violent_trend(source: DataFrame) -> DataFrame:
    violent = source.filter(F.col("primary_type").isin(*VIOLENT_TYPES))
    return _totals(violent, "year", name="violent_crimes").orderBy("year")


def by_location_and_type(source: DataFrame) -> DataFrame:
    return _totals(source, "location_description", "primary_type").orderBy(
        F.desc("total_crimes"), "location_description", "primary_type"
    )


def by_month(source: DataFrame) -> DataFrame:
    return _totals(source, "month").orderBy("month")


def domestic_arrests(source: DataFrame) -> DataFrame:
    return _totals(source.filter("domestic"), "arrest").orderBy("arrest")


def leading_type_per_season(source: DataFrame) -> DataFrame:
    return _leading(_totals(source, "season", "primary_type"), "season")


def place_totals(curated: DataFrame) -> DataFrame:
    """Row count per year and place, for the geographic report."""
    return _totals(curated, "year", "latitude", "longitude", name=ROWS)


def geographic_distribution(source: DataFrame) -> DataFrame:
    return _totals(source, "year", "latitude", "longitude").orderBy(
        "year", F.desc("total_crimes"), "latitude", "longitude"
    )


# --- fixed values: table name of each published report ---
CATEGORY_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "crimes_by_day_of_week": by_weekday,
    "most_common_crime_by_year": leading_type_per_year,
    "crimes_by_location": by_location,
    "crimes_vs_arrests": by_type_and_arrest,
    "violent_crimes_trend": violent_trend,
    "dangerous_locations_by_crime_type": by_location_and_type,
    "crimes_by_month": by_month,
    "domestic_incidents_arrests": domestic_arrests,
    "crimes_by_season": leading_type_per_season,
}
GEOGRAPHIC_REPORT = "geographic_crime_distribution"
