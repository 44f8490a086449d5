"""Variety of places by mergeable sketches: equal in batches and streams, bounded in size."""

import pytest
from pyspark.sql import functions as F

import replay
from precinct.operators.records import enrich
from precinct.operators.temporal import temporal_patterns
from precinct.plans import stream

PLACES = 10_000
KEYS = ["analysis_start", "primary_type", "hour_of_day", "is_weekend"]


@pytest.fixture(scope="module")
def crowded(spark):
    """Two types in 40 minutes; every window of one has more than 10,000 places."""
    second = F.col("id") % 2400
    rows = spark.range(0, 120_000, 1, 6).select(
        F.col("id").alias("crime_id"),
        F.timestamp_seconds(F.lit(1706781600)).alias("crime_date"),
        F.when(F.col("id") % 8 == 0, "THEFT").otherwise("ASSAULT").alias("primary_type"),
        F.concat(F.lit("place "), F.pmod(F.xxhash64("id"), F.lit(PLACES + 3_000))).alias(
            "location_description"
        ),
        F.lit(True).alias("arrest"),
        F.lit(False).alias("domestic"),
        (41 + F.col("id") % 64 / 64).alias("latitude"),
        (F.col("id") % 32 / 32 - 87).alias("longitude"),
        F.timestamp_seconds(F.lit(1706781600) + second).alias("event_time"),
    )
    return enrich(rows).cache()


def by_key(frame):
    names = [n for n in frame.columns if n not in KEYS]
    rounded = frame.withColumn("geographic_dispersion", F.round("geographic_dispersion", 6))
    return {tuple(r[k] for k in KEYS): tuple(r[n] for n in names) for r in rounded.collect()}


def test_batch_and_stream_give_equal_rows(spark, crowded, tmp_path):
    source = str(tmp_path / "in")
    crowded.repartitionByRange(6, "event_time").write.parquet(source)
    last = crowded.limit(1).withColumn("event_time", F.timestamp_seconds(F.lit(1706791600)))
    batch = by_key(temporal_patterns(crowded, places="sketch"))
    exact = by_key(temporal_patterns(crowded))
    assert batch.keys() == exact.keys()
    assert max(row[4] for row in exact.values()) > PLACES
    for key, row in exact.items():
        assert batch[key][:4] == row[:4] and batch[key][5:] == row[5:]
        assert batch[key][4] == pytest.approx(row[4], rel=0.05)
    # However the rows are dealt to tasks.
    for parts in (1, 17):
        assert by_key(temporal_patterns(crowded.repartition(parts), places="sketch")) == batch
    last.write.mode("append").parquet(source)
    own = replay.streaming_session(spark)
    for per_trigger in (2, 100):
        rows = stream.stored_incidents(own, source, crowded.schema, per_trigger)
        found = replay.collections_of(spark, {"t5": temporal_patterns(rows, places="sketch")})
        assert by_key(found["t5"]) == batch


def test_few_places_are_counted_exactly(spark, make_incidents):
    rows = [{"id": i, "at": i, "place": f"p{i % 150}" if i % 7 else None} for i in range(600)]
    rows.append({"id": 601, "at": 5, "place": ""})
    incidents = make_incidents(rows)
    assert by_key(temporal_patterns(incidents, places="sketch")) == by_key(temporal_patterns(incidents))
    none = make_incidents([{"place": None}])
    assert [r["location_diversity"] for r in temporal_patterns(none, places="sketch").collect()] == [0] * 3


def test_sketches_do_not_grow_with_the_vocabulary(spark, crowded):
    from precinct.operators import temporal

    size = crowded.groupBy("primary_type").agg(F.octet_length(temporal._sketch()).alias("n"))
    assert max(r["n"] for r in size.collect()) < 4_300


def test_ways_that_do_not_fit_are_refused(spark, crowded):
    with pytest.raises(ValueError):
        temporal_patterns(crowded, places="approximate")
    with pytest.raises(ValueError):
        temporal_patterns(crowded, places="none")
