"""Messages to enriched incidents (and back), for streams and batches alike."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.functions import calendar, text
from precinct.schema import RAW_TO_CURATED, VIOLENT_TYPES, WATERMARK_DELAY


def to_messages(raw: DataFrame, arrival: str | Column, missing: str | None = "") -> DataFrame:
    """Raw records as messages: key = ID, value = JSON of the whole row.

    ``arrival`` is an expression, or the name of a column that is not part of
    the record. Absent fields are sent as ``missing`` text, as a comma-separated
    source has them; ``None`` sends JSON nulls.
    """
    names = raw.columns
    if isinstance(arrival, str):
        names = [name for name in names if name != arrival]
        arrival = F.col(arrival)
    fields = {name: F.col(f"`{name}`").cast("string") for name in names}
    if missing is not None:
        fields = {name: F.coalesce(field, F.lit(missing)) for name, field in fields.items()}
    record = F.struct(*[field.alias(name) for name, field in fields.items()])
    return raw.select(
        fields["ID"].alias("key"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("value"),
        arrival.cast("timestamp").alias("timestamp"),
    )


def parse(messages: DataFrame) -> DataFrame:
    """JSON value to one text column per field; drops messages without a readable ID.

    The generator reads each text once. (Fields of a parsed struct would be
    pushed into the filters above as one more parse per field.) Text that is not
    a JSON object gives nulls, and of a repeated field the last value counts.
    """
    fields = F.json_tuple(F.col("value").cast("string"), *RAW_TO_CURATED)
    names = ["crime_date" if name == "date" else name for name in RAW_TO_CURATED.values()]
    return messages.select(fields.alias(*names), F.col("timestamp").alias("event_time")).filter(
        F.col("crime_id").isNotNull()
    )


def _typed() -> dict[str, Column]:
    return {
        "crime_id": text.parse_long(F.col("crime_id")),
        "crime_date": text.parse_timestamp(F.col("crime_date")),
        "arrest": text.parse_boolean(F.col("arrest")),
        "domestic": text.parse_boolean(F.col("domestic")),
        "latitude": text.parse_double(F.col("latitude")),
        "longitude": text.parse_double(F.col("longitude")),
    }


def extract(parsed: DataFrame) -> DataFrame:
    """Typed columns; drops records whose ID or occurrence time does not parse."""
    typed = parsed.withColumns(_typed())
    return typed.filter(F.col("crime_id").isNotNull() & F.col("crime_date").isNotNull())


def judged(messages: DataFrame) -> DataFrame:
    """All messages with typed columns and ``rejected_because``, null for what ``extract`` keeps.

    The key and the text of the message stay beside them. Like ``parse``, it reads each text once.
    """
    fields = F.json_tuple(F.col("value").cast("string"), *RAW_TO_CURATED)
    names = ["crime_date" if name == "date" else name for name in RAW_TO_CURATED.values()]
    read = messages.select("key", "value", fields.alias(*names), F.col("timestamp").alias("event_time"))
    typed = _typed()
    nothing = F.lit(True)
    for name in names:
        nothing &= F.col(name).isNull()
    reason = (
        F.when(nothing, "not a record")
        .when(F.col("crime_id").isNull(), "no ID")
        .when(typed["crime_id"].isNull(), "unreadable ID")
        .when(F.col("crime_date").isNull(), "no date")
        .when(typed["crime_date"].isNull(), "unreadable date")
    )
    return read.withColumns({**typed, "rejected_because": reason})


def enrich(incidents: DataFrame) -> DataFrame:
    moment = F.col("crime_date")
    return incidents.withColumns(
        {
            "hour_of_day": F.hour(moment),
            "day_of_week": calendar.weekday_name(moment),
            "month": F.month(moment),
            "year": F.year(moment),
            "is_violent": F.coalesce(F.col("primary_type").isin(*VIOLENT_TYPES), F.lit(False)),
            "is_weekend": calendar.is_weekend(calendar.weekday_name(moment)),
        }
    )


def incidents(messages: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Messages to enriched incidents.

    The watermark is declared here, once, before any branch splits off.
    """
    parsed = parse(messages)
    if messages.isStreaming:
        parsed = parsed.withWatermark("event_time", delay)
    return enrich(extract(parsed))
