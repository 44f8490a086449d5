"""Streams: restart, late rows, sinks, and the ends of queries."""

import math

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import __spark_entry__ as entry
import replay
from precinct.operators import records
from precinct.operators.correlation import domestic_correlation
from precinct.operators.escalation import violence_escalation
from precinct.operators.hotspots import hotspot_counts, hotspots, hotspots_from_counts
from precinct.operators.patterns import match_patterns
from precinct.plans import batch, stream
from precinct.sinks import documents
from precinct.sources.streams import file_messages, kafka_options
from precinct.streaming import runner
from tests.conftest import SMALL


@pytest.fixture
def messages(spark):
    return entry._messages(spark, SMALL)


def _run(results, name, writer, checkpoints):
    query = runner.start(results, name, writer, str(checkpoints), every=None)
    runner.drain([query])
    return query


def test_restart_goes_on_without_duplicates(spark, messages, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    writer = documents.file_collection(out, "s")

    def once():
        rows = records.incidents(file_messages(spark, source, files_per_trigger=1))
        _run(hotspots(rows), "restarted", writer, tmp_path / "checkpoints")

    bounds = replay.write_slices(messages, source, slices=3, files=1)
    once()
    first = spark.read.parquet(out).count()
    once()  # nothing new
    assert spark.read.parquet(out).count() == first
    # More of the same stream: everything again, an hour after the end.
    shift = bounds[-1] - bounds[0] + 3_600_000_000
    later = messages.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + shift))
    replay.publish_slice(later, source, bounds[0] + shift, bounds[-1] + shift, files=1)
    once()
    keys = spark.read.parquet(out).select("window_start", "geo_grid")
    assert keys.count() > first
    assert keys.count() == keys.distinct().count()


def test_late_rows_are_dropped_and_counted(spark, messages, tmp_path):
    source = str(tmp_path / "in")
    bounds = replay.write_slices(messages, source, files=1)
    replay.publish_slice(messages, source, bounds[0], bounds[1], files=1)
    rows = records.incidents(file_messages(spark, source, files_per_trigger=1))
    writer = documents.file_collection(str(tmp_path / "out"), "s")
    query = _run(violence_escalation(rows), "late", writer, tmp_path / "c")
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    assert dropped > 0


def test_late_row_still_counts_in_open_windows(spark, tmp_path):
    """A row behind the watermark misses closed windows only, not the open ones."""
    source = str(tmp_path / "in")

    def send(ident, second):
        value = '{"ID":"%d","Date":"01/05/2020 01:30:00 PM","Latitude":"41.5","Longitude":"-87.75"}'
        frame = spark.createDataFrame([(str(ident), value % ident, second)], "key string, value string, s long")
        frame = frame.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")
        frame.coalesce(1).write.mode("append").parquet(source)

    base = 1706781600  # 10:00:00
    for ident, second in enumerate([0, 150, 151, 20, 3600]):
        send(ident, base + second)
    rows = records.incidents(file_messages(spark, source, files_per_trigger=1))
    writer = documents.file_collection(str(tmp_path / "out"), "s")
    _run(hotspots(rows, min_count=1), "open", writer, tmp_path / "c")
    found = spark.read.parquet(str(tmp_path / "out")).withColumn(
        "minute", ((F.unix_timestamp("window_start") - base) / 60).cast("int")
    )
    counts = {r["minute"]: r["crime_count"] for r in found.collect()}
    # The watermark is at 10:02:20 when the row of 10:00:20 comes: the windows that
    # ended by 10:02 miss it, the later ones hold all four rows.
    assert counts == {-4: 1, -3: 1, -2: 4, -1: 4, 0: 4, 1: 2, 2: 2}


def test_stream_matches_patterns_too_many_to_broadcast(spark, messages, tmp_path):
    source = str(tmp_path / "in")
    replay.write_slices(messages, source, slices=2, files=1)
    patterns = entry._stored_patterns(spark, SMALL)
    found = []
    for way in (None, "merge"):
        rows = records.incidents(file_messages(spark, source, files_per_trigger=1))
        out = str(tmp_path / f"out-{way}")
        writer = documents.file_collection(out, "s")
        matched = match_patterns(rows, patterns, salts=3 if way else 1, strategy=way)
        _run(matched, f"patterns-{way}", writer, tmp_path / "c")
        found.append(spark.read.parquet(out).select(matched.columns))
    assert found[0].count() == found[1].count() >= messages.count()
    assert not found[0].filter("pattern_match").isEmpty()
    assert found[0].exceptAll(found[1]).isEmpty()


def test_streamed_hotspots_are_finished_per_batch_or_by_state(spark, messages, tmp_path):
    source = str(tmp_path / "in")
    replay.write_slices(messages, source, slices=3, files=1)

    def both(rows):
        enriched = records.incidents(rows)
        finished = runner.Result(
            hotspot_counts(enriched), lambda counts: hotspots_from_counts(counts, types="list")
        )
        return {"by_state": hotspots(enriched, types="list"), "by_batch": finished}

    found = replay.run_to_end(spark, source, both, files=1)
    by_state, by_batch = (frame.drop("analysis_timestamp") for frame in found.values())
    assert by_state.count() == by_batch.count() > 0
    assert by_state.exceptAll(by_batch).isEmpty()


def test_failed_batch_is_written_again_in_place(spark, messages, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    replay.write_slices(messages, source, slices=2, files=1)
    good = documents.file_collection(out, "s")
    attempts = []

    def breaks_after_writing(batch, batch_id):
        good(batch, batch_id)
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise RuntimeError("lost")

    def rows():
        return records.incidents(file_messages(spark, source, files_per_trigger=1))

    with pytest.raises(StreamingQueryException):
        _run(rows(), "broken", breaks_after_writing, tmp_path / "c")
    _run(rows(), "broken", breaks_after_writing, tmp_path / "c")
    assert attempts[:2] == [0, 0]
    assert spark.read.parquet(out).count() == messages.count()


def test_documents_have_nulls_metadata_and_arrays(spark):
    frame = spark.createDataFrame([(math.nan, ["a", "b"]), (1.5, None)], "x double, l array<string>")
    rows = documents.as_documents(frame, "s1").collect()
    assert [r["x"] for r in rows] == [None, 1.5]
    assert rows[0]["l"] == ["a", "b"]
    assert all(r["_session_id"] == "s1" and r["_inserted_at"] is not None for r in rows)


def test_one_failure_stops_all(spark, messages, tmp_path):
    source = str(tmp_path / "in")
    replay.write_slices(messages, source, slices=1, files=1)
    rows = file_messages(spark, source)

    def fails(batch, batch_id):
        raise RuntimeError("no store")

    writers = {"good": documents.file_collection(str(tmp_path / "o"), "s"), "bad": fails}
    queries = runner.start_all(
        {"good": rows, "bad": rows}, writers, str(tmp_path / "c"), every="1 second"
    )
    with pytest.raises(StreamingQueryException):
        runner.watch(spark, queries.values())
    assert not any(q.isActive for q in queries.values())


def test_watch_waits_for_its_own_queries(spark, messages, tmp_path):
    source = str(tmp_path / "in")
    replay.write_slices(messages, source, slices=1, files=1)
    rows = file_messages(spark, source)
    ended = runner.start(rows, "ended", documents.console(1), str(tmp_path / "c"), every=None)
    ended.awaitTermination()
    seen = []

    def stops_itself(batch, batch_id):
        seen.append(batch_id)

    query = runner.start(rows, "own", stops_itself, str(tmp_path / "c"), every=None)
    runner.watch(spark, [query])
    assert seen and not query.isActive


def test_documents_of_a_store_have_their_own_identity(spark, messages, tmp_path):
    """Through a file format that stands for the connector; a repeated batch has equal ids."""
    source, out = str(tmp_path / "in"), str(tmp_path / "store")
    replay.write_slices(messages, source, slices=2, files=1)
    patterns = entry._stored_patterns(spark, SMALL)
    matched = match_patterns(records.incidents(file_messages(spark, source)), patterns)
    identity = stream.COLLECTIONS["stream_pattern_analysis"]
    once = documents.store_collection("json", {"path": out}, identity, "s")
    _run(matched, "store", documents.to_all(once, once), tmp_path / "c")
    stored_documents = spark.read.json(out)
    assert stored_documents.count() == 2 * stored_documents.select("_id").distinct().count()
    assert stored_documents.count() >= 2 * messages.count()


def test_streams_without_messages_are_empty(spark, messages, tmp_path):
    source = str(tmp_path / "in")
    assert replay.write_slices(messages.limit(0), source) == []
    found = replay.run_to_end(
        spark, source, lambda rows: {"none": violence_escalation(records.incidents(rows))}
    )
    assert found["none"].count() == 0


def test_a_busy_cell_is_spread_over_the_state(spark, tmp_path, make_incidents):
    rows = [{"id": i, "at": i % 300, "domestic": i % 20 == 0} for i in range(600)]
    source = str(tmp_path / "in")
    make_incidents(rows).write.parquet(source)
    schema = spark.read.parquet(source).schema
    own = replay.streaming_session(spark)
    own.conf.set("spark.sql.shuffle.partitions", "8")
    counts = []
    for salts in (1, None):
        incidents = stream.stored_incidents(own, source, schema)
        tasks = []

        def sizes(batch, batch_id):
            rows = batch.groupBy(F.spark_partition_id()).count().collect()
            tasks.extend(r[1] for r in rows)

        pairs = domestic_correlation(incidents, salts=salts)
        _run(pairs, f"cell-{salts}", sizes, tmp_path / "c")
        counts.append(tasks)
    assert sum(counts[0]) == sum(counts[1]) > 0
    assert max(counts[1]) < max(counts[0])


def test_console_and_several_sinks(spark, messages, tmp_path, capfd):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    replay.write_slices(messages, source, slices=1, files=1)
    both = documents.to_all(documents.file_collection(out, "s"), documents.console(3))
    _run(file_messages(spark, source), "both", both, tmp_path / "c")
    assert spark.read.parquet(out).count() == messages.count()
    assert "batch 0" in capfd.readouterr().out
    query = runner.start_console(file_messages(spark, source), "console", str(tmp_path / "c"), every=None)
    runner.drain([query])


def test_topic_options():
    options = kafka_options("host:1", "topic-a", maxOffsetsPerTrigger="1000")
    assert options["subscribe"] == "topic-a" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "1000"
    # Messages that are gone end the query, unless the caller says otherwise.
    assert options["failOnDataLoss"] == "true"
    assert kafka_options("h", "t", failOnDataLoss="false")["failOnDataLoss"] == "false"


def test_patterns_are_renewed_while_the_stream_runs(spark, messages, tmp_path):
    """A rebuild between two micro-batches is used by the second, without a restart."""
    source, out, path = (str(tmp_path / name) for name in ("in", "out", "patterns"))
    replay.write_slices(messages, source, slices=2, files=1)
    history = entry.tables.events(spark, SMALL).withColumnRenamed("crime_date", "date")
    batch.build_patterns(history.limit(0), path)
    once = documents.file_collection(out, "s")

    def write(rows, batch_id):
        once(rows, batch_id)
        if batch_id == 0:
            batch.build_patterns(history, path)

    rows = records.incidents(file_messages(spark, source, files_per_trigger=1))
    found = stream.matched(rows, lambda session: batch.current_patterns(session, path))
    _run(found, "renewed", write, tmp_path / "c")
    by_batch = spark.read.parquet(out).groupBy("batch_id").agg(F.count_if("pattern_match").alias("n"))
    matched = {r["batch_id"]: r["n"] for r in by_batch.collect()}
    assert matched[0] == 0 and matched[1] > 0


def test_state_reads_a_key_once(spark, tmp_path):
    """A key that is new is looked up once, not again to count the rows of the store."""
    source = str(tmp_path / "in")
    spark.range(200).selectExpr("id", "timestamp_seconds(id + 1) AS t").write.parquet(source)
    rows = replay.streaming_session(spark).readStream.schema("id bigint, t timestamp").parquet(source)
    counts = rows.withWatermark("t", "10 days").groupBy("t", "id").count()
    query = runner.start(counts, "gets", lambda batch, _: batch.collect(), str(tmp_path / "c"), None)
    runner.drain([query])
    store = query.recentProgress[0]["stateOperators"][0]
    assert store["numRowsUpdated"] == 200
    assert store["customMetrics"]["rocksdbGetCount"] == 200


def test_packed_slices_have_files_for_all_slots(spark, tmp_path, monkeypatch):
    """Sixteen micro-batches, of as many files as the machine has slots."""
    made = spark.range(4_000).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00'").alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit('{"k": 1}').alias("props"),
    )
    made.write.parquet(str(tmp_path / "events.parquet"))
    batches, real = [], entry.Collection.write

    def write(self, batch, batch_id):
        batches.append((batch_id, batch.rdd.getNumPartitions()))
        real(self, batch, batch_id)

    monkeypatch.setattr(entry.Collection, "write", write)
    found = entry.sink_packed(spark, str(tmp_path))
    assert found.count() == found.select("crime_id").distinct().count() == 4_000
    assert sorted({batch_id for batch_id, _ in batches}) == list(range(16))
    assert all(parts > 1 for _, parts in batches)
