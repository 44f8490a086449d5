"""Messages to incidents and back."""

from pyspark.sql import functions as F

from precinct.operators import records
from precinct.sources import tables
from tests.conftest import SMALL

GOOD = '"Date":"01/05/2020 01:30:00 PM"'


def _ids(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "value string").withColumn(
        "timestamp", F.lit("2024-02-01 10:00:00").cast("timestamp")
    )
    return [r["crime_id"] for r in records.incidents(frame).collect()]


def test_unreadable_messages_are_dropped(spark):
    bad = ["bad", "[1]", "5", "", None, '{"ID":"1","Date', '[{"ID":"1",%s}]' % GOOD,
           "{%s}" % GOOD, '{"ID":null,%s}' % GOOD, '{"ID":"abc",%s}' % GOOD,
           '{"ID":"1","Date":"garbage"}', '{"ID":"1"}']
    assert _ids(spark, bad) == []


def test_numbers_nested_values_and_repeated_fields(spark):
    assert _ids(spark, ['{"ID":5,%s}' % GOOD]) == [5]
    assert _ids(spark, ['{"ID":"5",%s,"Block":{"a":[1]}}' % GOOD]) == [5]
    assert _ids(spark, ['{"ID":"5","ID":"6",%s}' % GOOD]) == [6]


def test_flags(spark):
    value = '{"ID":"%d",%s,"Primary Type":%s,"Arrest":"true"}'
    kinds = {1: '"HOMICIDE"', 2: '"THEFT"', 3: "null"}
    frame = spark.createDataFrame(
        [(value % (i, GOOD, kind),) for i, kind in kinds.items()], "value string"
    ).withColumn("timestamp", F.current_timestamp())
    rows = {r["crime_id"]: r for r in records.incidents(frame).collect()}
    assert [rows[i]["is_violent"] for i in (1, 2, 3)] == [True, False, False]
    first = rows[1]
    assert (first["hour_of_day"], first["day_of_week"], first["is_weekend"]) == (13, "Sunday", True)
    assert first["arrest"] is True and first["domestic"] is None


def test_messages_round_trip(spark):
    sent = tables.events(spark, SMALL)
    raw = tables.as_raw(sent, "crime_date", "event_time")
    back = records.extract(records.parse(records.to_messages(raw, "event_time", missing=None)))
    expected = sent.withColumn("crime_date", F.date_trunc("second", "crime_date"))
    columns = expected.columns
    assert back.select(columns).exceptAll(expected).isEmpty()
    assert expected.exceptAll(back.select(columns)).isEmpty()


def test_absent_fields_are_sent_as_empty_text(spark):
    raw = spark.createDataFrame([("1", None)], "ID string, Place string")
    message = records.to_messages(raw, F.current_timestamp()).first()
    assert message["key"] == "1" and message["value"] == '{"ID":"1","Place":""}'
