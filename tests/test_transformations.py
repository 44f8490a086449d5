"""The five transformations on small inputs, against brute force."""

import random
from collections import defaultdict
from datetime import timedelta

import pytest

from precinct.operators.correlation import domestic_correlation
from precinct.operators.escalation import violence_escalation
from precinct.operators.hotspots import hotspots
from precinct.operators.lookup import lookup_join
from precinct.operators.patterns import historical_patterns, match_patterns
from precinct.operators.sliding import sliding_entries, sliding_totals
from precinct.operators.temporal import temporal_patterns


def _random_rows(count, seed, hot=0.0):
    """Rows over about an hour; a share of them in one cell, of one type."""
    pick = random.Random(seed)
    kinds = ["HOMICIDE", "ASSAULT", "THEFT", None]
    rows = []
    for i in range(count):
        row = {"id": i, "at": pick.randrange(-1800, 1800), "domestic": pick.choice([True, False, None])}
        if pick.random() < hot:
            row |= {"type": "HOMICIDE", "lat": 41.5, "lon": -87.75}
        else:
            row |= {
                "type": pick.choice(kinds),
                "lat": pick.choice([41.5, 41.515625, 41.75, None]),
                "lon": pick.choice([-87.75, -87.5]),
                "arrest": pick.choice([True, False, None]),
            }
        rows.append(row)
    return rows


def _windows_of(moment, length, slide):
    """All window starts that cover a time, by definition."""
    minute = moment.replace(second=0, microsecond=0)
    last = minute - timedelta(minutes=minute.minute % slide)
    return [last - timedelta(minutes=back) for back in range(0, length, slide)]


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_hotspots_by_brute_force(make_incidents, hot):
    frame = make_incidents(_random_rows(150, 1, hot))
    groups = defaultdict(list)
    for r in frame.collect():
        if r["latitude"] is not None:
            for start in _windows_of(r["event_time"], 5, 1):
                groups[start, round(r["latitude"] + 1e-9, 2), round(r["longitude"], 2)].append(r)
    expected = {
        (start, f"{lat}_{lon}"): (
            len(rows),
            sorted(r["primary_type"] for r in rows if r["primary_type"]),
            len({r["primary_type"] for r in rows} - {None}),
            sum(r["latitude"] for r in rows) / len(rows),
        )
        for (start, lat, lon), rows in groups.items()
        if len(rows) >= 2
    }
    found = {
        (r["window_start"], r["geo_grid"]): (
            r["crime_count"],
            r["crime_types"],
            r["crime_variety"],
            r["avg_lat"],
        )
        for r in hotspots(frame, types="list").collect()
    }
    assert found == expected
    counts = {
        (r["window_start"], r["geo_grid"]): r["crime_types"]
        for r in hotspots(frame, types="counts").collect()
    }
    for key, (_, kinds, _, _) in expected.items():
        assert counts[key] == {kind: kinds.count(kind) for kind in kinds}


@pytest.mark.parametrize("chunk", [1, 3, 5, 7, 64])
def test_windows_do_not_depend_on_the_chunk(make_incidents, chunk):
    from pyspark.sql import functions as F

    frame = make_incidents(_random_rows(120, 2))
    args = (frame, "event_time", 6, 2, ["latitude"])
    entries = sliding_entries(*args, "primary_type", {"n": F.count("*")}, chunk=chunk)
    counted = entries.select(
        "window", "latitude", F.aggregate("entries", F.lit(0).cast("bigint"), lambda t, e: t + e["n"]).alias("n")
    )
    totals = sliding_totals(*args, {"n": F.count("*")})
    plain = frame.groupBy(F.window("event_time", "6 minutes", "2 minutes").alias("window"), "latitude").agg(
        F.count("*").alias("n")
    )
    key = lambda r: str(r)
    expected = sorted(plain.collect(), key=key)
    assert sorted(counted.collect(), key=key) == expected
    assert sorted(totals.collect(), key=key) == expected


def test_slide_must_divide_length(make_incidents):
    with pytest.raises(ValueError):
        sliding_totals(make_incidents([{}]), "event_time", 5, 2, [], {})


def test_escalation_keeps_unlocated_incidents(make_incidents):
    frame = make_incidents(
        [
            {"type": "HOMICIDE", "lat": None, "arrest": True},
            {"type": "BATTERY", "lat": 41.5, "lon": None, "arrest": None},
            {"type": "ASSAULT", "at": 30},
            {"type": "THEFT"},
        ]
    )
    rows = violence_escalation(frame).collect()
    assert len(rows) == 10  # five windows for each of two zones
    unlocated = [r for r in rows if r["geo_zone"] is None]
    assert {(r["violent_incidents"], r["violence_types"], r["arrests_made"]) for r in unlocated} == {(2, 2, 1)}
    assert {(r["zone_lat"], r["zone_lon"]) for r in unlocated} == {(41.5, -87.75)}
    assert {r["arrest_effectiveness"] for r in unlocated} == {50.0}
    located = [r for r in rows if r["geo_zone"] is not None]
    assert {(r["escalation_risk"], r["assaults"], r["homicides"]) for r in located} == {("NORMAL", 1, 0)}


def test_single_row_has_no_dispersion(make_incidents):
    rows = temporal_patterns(make_incidents([{"arrest": None}])).collect()
    assert len(rows) == 3
    assert {(r["geographic_dispersion"], r["arrest_rate"], r["crime_intensity"]) for r in rows} == {(0.0, 0.0, "LOW")}


def test_correlation_bounds(make_incidents):
    other = {"id": 1, "at": 0, "domestic": False}
    domestic = [
        {"id": 10 + i, "at": at, "domestic": True} for i, at in enumerate([0, 1800, 1801, -1, 900])
    ]
    unlocated = {"id": 20, "at": 0, "domestic": True, "lat": None}
    unknown = {"id": 21, "at": 0, "domestic": None}
    found = domestic_correlation(make_incidents([other, *domestic, unlocated, unknown])).collect()
    assert {(r["d_crime_id"], r["time_diff_minutes"]) for r in found} == {(10, 0.0), (11, 30.0), (14, 15.0)}


@pytest.mark.parametrize("hot", [0.0, 0.4])
@pytest.mark.parametrize("slot, salts", [(None, 1), (7, 1), (45, 3)])
def test_correlation_by_brute_force(make_incidents, hot, slot, salts):
    frame = make_incidents(_random_rows(150, 3, hot))
    rows = [r for r in frame.collect() if r["latitude"] is not None]
    cell = lambda r: (round(r["latitude"] + 1e-9, 2), round(r["longitude"], 2))
    expected = sorted(
        (d["crime_id"], nd["crime_id"])
        for d in rows
        for nd in rows
        if d["domestic"] is True and nd["domestic"] is False and cell(d) == cell(nd)
        and timedelta(0) <= d["event_time"] - nd["event_time"] <= timedelta(minutes=30)
    )
    pairs = domestic_correlation(frame, slot_minutes=slot, salts=salts).collect()
    assert sorted((r["d_crime_id"], r["nd_crime_id"]) for r in pairs) == expected


def test_patterns_fan_out_or_not(make_incidents):
    history = make_incidents([{"place": "STREET"}, {"place": "STREET"}, {"place": "ALLEY"}])
    stream = make_incidents([{"id": 1}, {"id": 2, "type": "ARSON"}, {"id": 3, "type": None}])
    fanned = match_patterns(stream, historical_patterns(history)).collect()
    found = sorted((r["crime_id"], r["historical_frequency"] or 0, r["anomaly_score"]) for r in fanned)
    assert found == [(1, 1, 0.0), (1, 2, 0.0), (2, 0, 1.0), (3, 0, 1.0)]
    single = match_patterns(stream, historical_patterns(history, per_location=False)).collect()
    assert {r["crime_id"]: r["historical_frequency"] for r in single} == {1: 3, 2: None, 3: None}


def test_lookup_join_ways_agree(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)], "id long, k string")
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3)], "k string, v int")
    small = lookup_join(facts, lookup, ["k"], ["id"])
    large = lookup_join(facts, lookup, ["k"], ["id"], salts=5, strategy="merge")
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert small.count() == 40 * 2 + 20
