"""Text to typed values; text that does not parse becomes null, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from precinct.schema import DATE_PATTERN


def parse_timestamp(text: Column, pattern: str = DATE_PATTERN) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def parse_boolean(text: Column) -> Column:
    return text.try_cast("boolean")


def parse_double(text: Column) -> Column:
    return text.try_cast("double")


def parse_long(text: Column) -> Column:
    return text.try_cast("bigint")
