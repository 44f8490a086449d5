"""Edges of the column expressions."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from precinct.functions import calendar, geo, levels, text


def _values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_season_of_every_month(spark):
    months = [(m,) for m in range(1, 13)] + [(None,), (13,)]
    found = _values(spark, months, "m int", calendar.season(F.col("m")))
    expected = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    assert found == [*expected, "Unknown", "Unknown"]


def test_time_category_edges(spark):
    hours = {0: "NIGHT", 5: "NIGHT", 6: "MORNING", 12: "MORNING", 13: "AFTERNOON",
             18: "AFTERNOON", 19: "EVENING", 23: "EVENING", None: "NIGHT"}
    found = _values(spark, [(h,) for h in hours], "h int", calendar.time_category(F.col("h")))
    assert found == list(hours.values())


@pytest.mark.parametrize(
    "scale, expected",
    [
        (levels.HOTSPOT_SEVERITY, ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH"]),
        (levels.ESCALATION_RISK, ["NORMAL", "HIGH", "HIGH", "CRITICAL", "CRITICAL"]),
        (levels.CRIME_INTENSITY, ["LOW", "MEDIUM", "HIGH", "HIGH", "VERY_HIGH"]),
    ],
)
def test_levels_of_one_to_five(spark, scale, expected):
    found = _values(spark, [(n,) for n in range(1, 6)], "n long", levels.level(F.col("n"), scale))
    assert found == expected


def test_unreadable_text_is_null(spark):
    rows = [("garbage", "maybe", "north", "abc"), ("1/5/2020 1:30:00 PM", "", "", ""),
            ("", None, None, None)]
    found = spark.createDataFrame(rows, "d string, b string, x string, i string").select(
        text.parse_timestamp(F.col("d")),
        text.parse_boolean(F.col("b")),
        text.parse_double(F.col("x")),
        text.parse_long(F.col("i")),
    )
    assert [tuple(r) for r in found.collect()] == [(None,) * 4] * 3


def test_readable_text(spark):
    row = [("01/05/2020 01:30:00 PM", "true", "41.5", "7")]
    found = spark.createDataFrame(row, "d string, b string, x string, i string").select(
        F.date_format(text.parse_timestamp(F.col("d")), "yyyy-MM-dd HH:mm:ss"),
        text.parse_boolean(F.col("b")),
        text.parse_double(F.col("x")),
        text.parse_long(F.col("i")),
    )
    assert tuple(found.first()) == ("2020-01-05 13:30:00", True, 41.5, 7)


coordinate = st.one_of(st.none(), st.floats(-180, 180, allow_nan=False))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(coordinate, coordinate), min_size=1, max_size=30))
def test_grid_key_is_null_only_without_coordinates(spark, points):
    found = _values(
        spark, points, "lat double, lon double", geo.grid_key(F.col("lat"), F.col("lon"), 2)
    )
    assert [key is None for key in found] == [lat is None or lon is None for lat, lon in points]


def test_grid_key_rounds_half_up(spark):
    found = _values(
        spark, [(41.625, -87.625)], "lat double, lon double", geo.grid_key(F.col("lat"), F.col("lon"), 2)
    )
    assert found == ["41.63_-87.63"]
