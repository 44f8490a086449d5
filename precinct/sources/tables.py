"""Incidents derived from the generic ``events`` and ``orders`` test tables.

The derivation follows the mapping of FIXTURES.md. Coordinates are multiples of
1/8192 degree, so that sums of them are exact in any order.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.operators.etl import located, with_calendar, with_season
from precinct.schema import CURATED, DATE_PATTERN, RAW_TO_CURATED

# --- fixed values: category of each event type, order priority and status ---
EVENT_TYPES = {
    "error": "BATTERY",
    "purchase": "THEFT",
    "signup": "ASSAULT",
    "view": "NARCOTICS",
    "click": "HOMICIDE",
}
ORDER_TYPES = {
    "1-URGENT": "HOMICIDE",
    "2-HIGH": "BATTERY",
    "3-MEDIUM": "THEFT",
    "4-NOT SPECIFIED": "NARCOTICS",
    "5-LOW": "ROBBERY",
}
ORDER_PLACES = {"F": "STREET", "O": "RESIDENCE", "P": "APARTMENT"}
EVENT_PLACES = {0: "STREET", 1: "RESIDENCE", 2: "APARTMENT"}
# Stated, so that no job has to read them from the files first.
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string"
)
ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string"
)
FIRST_ARRIVAL = 1706745600  # 2024-02-01 00:00:00 UTC
ARRIVAL_SECONDS = 5


def _mapped(key: Column, mapping: dict) -> Column:
    result = F.lit(None).cast("string")
    for value, label in mapping.items():
        result = F.when(key == value, label).otherwise(result)
    return result


def _unless_missing(row_id: str, value: Column) -> Column:
    """Every fiftieth record has no coordinates."""
    return F.when(F.col(row_id) % 50 != 0, value)


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Incidents as they come out of the stream parser, without the enrichment."""
    table = spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")
    # A generator, so that the text is parsed once for all columns made from it.
    table = table.select("*", F.json_tuple("props", "k").alias("k"))
    k = F.col("k").cast("int")
    user = F.col("user_id")
    return table.select(
        F.col("event_id").alias("crime_id"),
        F.concat(F.lit("C"), F.col("event_id")).alias("case_number"),
        F.col("ts").cast("timestamp").alias("crime_date"),
        _mapped(F.col("event_type"), EVENT_TYPES).alias("primary_type"),
        F.concat(F.lit("event, no. "), F.col("event_id")).alias("description"),
        _mapped(user % 4, EVENT_PLACES).alias("location_description"),
        (k % 2 == 0).alias("arrest"),
        (k % 3 == 0).alias("domestic"),
        _unless_missing("event_id", 41.5 + (user % 5) / 64 + k / 8192).alias("latitude"),
        _unless_missing("event_id", -87.75 + (user % 3) / 64 + k / 8192).alias("longitude"),
        F.timestamp_seconds(FIRST_ARRIVAL + ARRIVAL_SECONDS * F.col("event_id")).alias(
            "event_time"
        ),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Incidents over several years, as typed by the ETL but not yet filtered."""
    table = spark.read.schema(ORDERS_SCHEMA).parquet(f"{folder}/orders.parquet")
    cust = F.col("o_custkey")
    return table.select(
        F.col("o_orderkey").alias("crime_id"),
        F.concat(F.lit("C"), F.col("o_orderkey")).alias("case_number"),
        F.col("o_orderdate").cast("timestamp").alias("date"),
        _mapped(F.col("o_orderpriority"), ORDER_TYPES).alias("primary_type"),
        F.concat(F.lit("order, no. "), F.col("o_orderkey")).alias("description"),
        _mapped(F.col("o_orderstatus"), ORDER_PLACES).alias("location_description"),
        (F.col("o_orderkey") % 2 == 0).alias("arrest"),
        (cust % 3 == 0).alias("domestic"),
        _unless_missing("o_orderkey", 41.5 + (cust % 8) / 64).alias("latitude"),
        _unless_missing("o_orderkey", -87.75 + (cust % 4) / 64).alias("longitude"),
    )


def curated_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The curated table that the reports read."""
    steps = with_season(with_calendar(located(orders(spark, folder))))
    return steps.select(CURATED.fieldNames())


def as_raw(incidents: DataFrame, moment: str, *extra: str | Column) -> DataFrame:
    """Typed incidents back to raw text records, with ``extra`` columns behind."""
    columns = []
    for name, alias in RAW_TO_CURATED.items():
        if alias == "date":
            columns.append(F.date_format(moment, DATE_PATTERN).alias(name))
        else:
            columns.append(F.col(alias).cast("string").alias(name))
    return incidents.select(*columns, *extra)


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Raw text records with a time of day and, at fixed intervals, bad text."""
    key = F.col("crime_id")
    timed = orders(spark, folder).withColumn(
        "date", F.timestamp_add("SECOND", (key % 86400).cast("int"), F.col("date"))
    )
    raw = as_raw(timed, "date")
    row = F.col("ID").cast("bigint")
    bad_date = (
        F.when(row % 97 == 0, "garbage")
        .when(row % 97 == 1, "1/5/2000 1:30:00 PM")
        .otherwise(F.col("Date"))
    )
    return raw.withColumns(
        {
            "Date": bad_date,
            "Arrest": F.when(row % 89 == 0, "maybe").otherwise(F.col("Arrest")),
            "Domestic": F.when(row % 83 == 0, "Y").otherwise(F.col("Domestic")),
            "Latitude": F.when(row % 79 == 0, "north").otherwise(F.col("Latitude")),
        }
    )
