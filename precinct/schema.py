"""Record layouts and the fixed values the results depend on."""

from pyspark.sql import types as T

# --- fixed values: header names of the raw records and their curated names ---
RAW_TO_CURATED = {
    "ID": "crime_id",
    "Case Number": "case_number",
    "Date": "date",
    "Primary Type": "primary_type",
    "Description": "description",
    "Location Description": "location_description",
    "Arrest": "arrest",
    "Domestic": "domestic",
    "Latitude": "latitude",
    "Longitude": "longitude",
}

# --- fixed values: text form of the occurrence time in raw records ---
DATE_PATTERN = "MM/dd/yyyy hh:mm:ss a"

# --- fixed values: categories counted as violent ---
VIOLENT_TYPES = ("HOMICIDE", "ASSAULT", "BATTERY", "ROBBERY")

# --- fixed values: weekday names counted as weekend ---
WEEKEND_DAYS = ("Saturday", "Sunday")

# --- fixed values: month numbers of each season; anything else is "Unknown" ---
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}
UNKNOWN_SEASON = "Unknown"

# --- fixed values: watermark delay and the join bound ---
WATERMARK_DELAY = "10 seconds"
CORRELATION_MINUTES = 30

# --- fixed values: processing-time triggers of the two sinks ---
DOCUMENT_TRIGGER = "30 seconds"
CONSOLE_TRIGGER = "45 seconds"

# A message as it arrives from a topic: key, JSON text, arrival time.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

CURATED = T.StructType(
    [
        T.StructField("crime_id", T.LongType()),
        T.StructField("case_number", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("primary_type", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("location_description", T.StringType()),
        T.StructField("arrest", T.BooleanType()),
        T.StructField("domestic", T.BooleanType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("season", T.StringType()),
    ]
)
