"""Calendar columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from precinct.functions.levels import first_of
from precinct.schema import SEASONS, UNKNOWN_SEASON, WEEKEND_DAYS

# --- fixed values: hour ranges, both ends included; the earlier one wins ---
DAY_PARTS = (("MORNING", 6, 12), ("AFTERNOON", 12, 18), ("EVENING", 18, 24))
OTHER_DAY_PART = "NIGHT"


def weekday_name(moment: Column) -> Column:
    return F.date_format(moment, "EEEE")


def season(month: Column) -> Column:
    """Season of a month number; ``Unknown`` for null."""
    return first_of([(month.isin(*ms), name) for name, ms in SEASONS.items()], UNKNOWN_SEASON)


def is_weekend(weekday: Column) -> Column:
    return F.coalesce(weekday.isin(*WEEKEND_DAYS), F.lit(False))


def time_category(hour: Column) -> Column:
    """Part of the day of an hour; ``NIGHT`` for null."""
    return first_of([(hour.between(lo, hi), name) for name, lo, hi in DAY_PARTS], OTHER_DAY_PART)
