"""The ingest: outcomes of messages, lateness, busy cells, and repeated micro-batches."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import __spark_entry__ as entry
import replay
from precinct.operators.correlation import SLOT_SECONDS, domestic_correlation
from precinct.operators.sliding import missed_windows
from precinct.plans import folders, stream
from precinct.sources.streams import file_messages
from precinct.streaming import runner
from precinct.streaming.ingest import Busy
from tests.conftest import SMALL

BASE = 1706781600  # 10:00:00, the beginning of a slot


def send(spark, source, rows):
    """One file of messages; rows are (ID, second, fields or text)."""
    made = []
    for ident, second, more in rows:
        fields = {"ID": str(ident), "Date": "01/05/2020 01:30:00 PM"}
        text = more if isinstance(more, str) else json.dumps(fields | more)
        made.append((str(ident), text, BASE + second))
    frame = spark.createDataFrame(made, "key string, value string, s long")
    frame = frame.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")
    frame.coalesce(1).write.mode("append").parquet(source)


def run(spark, source, path, checkpoints, **options):
    messages = file_messages(spark, source, files_per_trigger=1)
    query, schema = stream.store_incidents(messages, str(path), str(checkpoints), None, **options)
    runner.drain([query])
    return stream.ingest(str(path)), schema


def test_every_message_is_accepted_or_rejected(spark, tmp_path):
    source = str(tmp_path / "in")
    bad = [
        (1, "not json", "not a record"),
        (2, "[1, 2]", "not a record"),
        (3, '{"Case Number": "C3"}', "no ID"),
        (4, {"ID": "four"}, "unreadable ID"),
        (5, {"Date": "1/5/2020"}, "unreadable date"),
        (6, '{"ID": "6"}', "no date"),
        (7, "", "not a record"),
    ]
    send(spark, source, [(i, i, more) for i, more, _ in bad] + [(8, 9, {}), (9, 9, {"Arrest": "maybe"})])
    target, schema = run(spark, source, tmp_path / "out", tmp_path / "c")
    rejected = target.read(spark, "rejected").collect()
    assert {int(r["key"]): r["rejected_because"] for r in rejected} == {i: why for i, _, why in bad}
    assert all(r["value"] is not None for r in rejected)
    accepted = target.read(spark, "accepted")
    assert sorted(r["crime_id"] for r in accepted.collect()) == [8, 9]
    assert accepted.filter("key IS NOT NULL OR value IS NOT NULL").isEmpty()
    assert set(schema.fieldNames()) <= set(accepted.columns)
    totals = target.last(spark)["totals"]
    assert totals == {"messages": 9, "accepted": 2, "rejected": 7, "late": 0}


def test_late_rows_are_kept_and_nothing_else_is_missing(spark, tmp_path):
    """Counts of a finished stream plus the missed windows are all windows of all rows."""
    source = str(tmp_path / "in")
    here = {"Latitude": "41.5", "Longitude": "-87.75", "Primary Type": "ASSAULT"}
    seconds = [0, 400, 900, 30, 1500, 880, 200, 7200]
    for ident, second in enumerate(seconds):
        send(spark, source, [(ident, second, here)])
    target, schema = run(spark, source, tmp_path / "out", tmp_path / "c")
    late = target.read(spark, "late").select("crime_id", F.inline("missed")).collect()
    missed = {}
    for row in late:
        missed.setdefault(row["collection"], {})[row["crime_id"]] = row["windows"]
    # Latest arrivals before rows 3, 5 and 6: 900, 1500, 1500.
    assert missed["stream_crime_hotspots"] == {3: 5, 5: 5, 6: 5}
    assert missed["stream_violence_escalation"] == {3: 5, 5: 5, 6: 5}
    assert missed["stream_temporal_patterns"] == {3: 2, 5: 2, 6: 3}
    assert missed["stream_domestic_correlation"] == {3: 1, 5: 1, 6: 1}
    own = replay.streaming_session(spark)
    for per_trigger in (1, 100):
        rows = stream.stored_incidents(own, target.folder("accepted"), schema, per_trigger)
        found = replay.collections_of(spark, stream.transformations(rows, entry._stored_patterns(spark, SMALL)))
        zones = found["stream_violence_escalation"].agg(F.sum("violent_incidents")).first()[0]
        spots = found["stream_temporal_patterns"].agg(F.sum("incident_count")).first()[0]
        # The windows of the last row are still open.
        assert zones == 5 * (len(seconds) - 1) - sum(missed["stream_violence_escalation"].values())
        assert spots == 3 * (len(seconds) - 1) - sum(missed["stream_temporal_patterns"].values())
        matched = found["stream_pattern_analysis"].select("crime_id").distinct()
        assert matched.count() == len(seconds)


@pytest.mark.parametrize("length, slide", [(5, 1), (10, 2), (15, 5)])
def test_missed_windows(spark, length, slide):
    cases = [(t, w) for t in range(0, 1200, 37) for w in (None, 0, 299, 300, 301, 905, 1800, 4000)]
    frame = spark.createDataFrame(cases, "t long, w long")
    moment, mark = F.timestamp_seconds(F.col("t")), F.timestamp_seconds(F.col("w"))
    got = frame.select("t", "w", missed_windows(moment, mark, length, slide).alias("n")).collect()
    step = 60 * slide
    for t, w, n in got:
        ends = [t // step * step - k * step + 60 * length for k in range(length // slide)]
        assert n == (None if w is None else sum(end <= w for end in ends))


def crowd(spark, source, slots):
    """Per slot 40 rows of one cell and 4 of others; every tenth is domestic."""
    ident = 0
    for slot in range(slots):
        rows = []
        for i in range(44):
            place = {"Latitude": "41.5", "Longitude": "-87.75"}
            if i % 11 == 10:
                place = {"Latitude": str(41 + i / 100), "Longitude": "-87.0"}
            more = place | {"Domestic": str(ident % 10 == 0).lower()}
            rows.append((ident, slot * SLOT_SECONDS + 13 * i, more))
            ident += 1
        send(spark, source, rows)


def test_only_busy_cells_are_salted_and_no_pair_is_lost(spark, tmp_path):
    source = str(tmp_path / "in")
    crowd(spark, source, 8)
    target, schema = run(spark, source, tmp_path / "out", tmp_path / "c", busy=Busy(rows_per_state=10))
    state = target.last(spark)
    assert list(state["cells"]) == ["41.5_-87.75"]
    (since, salts), *_ = state["cells"]["41.5_-87.75"]
    assert since == BASE // SLOT_SECONDS + 1 and salts == 4
    rows = target.read(spark, "accepted")
    assert rows.filter("latitude <> 41.5 AND cell_salts IS NOT NULL").isEmpty()
    # Slots before the first salted one keep one salt, also where later rows touch them.
    of = rows.filter("latitude = 41.5").groupBy((F.unix_timestamp("event_time") - BASE) / SLOT_SECONDS)
    assert rows.filter("cell_salts IS NOT NULL").select(F.size("cell_salts")).distinct().count() == 1
    assert of.count().count() > 8
    second = rows.filter(F.floor((F.unix_timestamp("event_time") - BASE) / SLOT_SECONDS) == 1)
    hot = second.filter("latitude = 41.5").select("cell_salts").distinct().collect()
    assert [r[0] for r in hot] == [[1, 1, 1, 4]]
    expected = domestic_correlation(rows.drop("cell_salts", "watermark"))
    pairs = ["d_crime_id", "nd_crime_id"]
    by_salt = domestic_correlation(rows).select(pairs)
    assert by_salt.count() == expected.count() > 0
    own = replay.streaming_session(spark)
    streamed = stream.stored_incidents(own, target.folder("accepted"), schema, 1)
    found = replay.collections_of(spark, {"pairs": domestic_correlation(streamed)})["pairs"]
    assert found.select(pairs).exceptAll(expected.select(pairs)).isEmpty()
    assert found.count() == expected.count()


def test_a_row_of_a_cold_cell_has_four_state_rows(spark, tmp_path):
    source = str(tmp_path / "in")
    crowd(spark, source, 3)
    target, schema = run(spark, source, tmp_path / "out", tmp_path / "c")
    rows = target.read(spark, "accepted")
    assert rows.filter("cell_salts IS NOT NULL").isEmpty()
    domestic = rows.filter("domestic").count()
    others = rows.count() - domestic
    own = replay.streaming_session(spark)
    streamed = stream.stored_incidents(own, target.folder("accepted"), schema)
    held = []
    query = runner.start(
        domestic_correlation(streamed), "pairs", lambda batch, _: batch.collect(), str(tmp_path / "c2"), None
    )
    runner.drain([query])
    for progress in query.recentProgress:
        held += [op["numRowsUpdated"] for op in progress["stateOperators"]]
    assert max(held) <= 4 * domestic + others


def test_salts_go_down_when_a_cell_calms(spark):
    target = stream.ingest("unused", Busy(rows_per_state=10, most_salts=8))
    cells = target.steps({}, {"a": 95.0, "b": 3.0}, 100)
    assert cells == {"a": [[101, 8]]}
    assert target.steps(cells, {"a": 45.0}, 110) == {"a": [[101, 8]]}
    cells = target.steps(cells, {"a": 31.0}, 120)
    assert cells == {"a": [[101, 8], [121, 4]]}
    calm = target.steps(cells, {}, 130)
    assert calm == {"a": [[101, 8], [121, 4], [131, 1]]}
    # A step that no row can reach any more is forgotten.
    assert target.steps(calm, {}, 130 + 2 * target.busy.slots + 1) == {}


def test_repeated_micro_batch_leaves_what_is_there(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "in")
    crowd(spark, source, 3)
    whole, _ = run(spark, source, tmp_path / "whole", tmp_path / "c1", busy=Busy(rows_per_state=10))
    for step in ("move", "write_text"):
        for fails_at in (1, 2):
            path = tmp_path / f"out-{step}-{fails_at}"
            calls = []
            real = getattr(folders, step)

            def breaks(*args, real=real, calls=calls, fails_at=fails_at):
                calls.append(args)
                if len(calls) == fails_at:
                    raise RuntimeError("lost")
                return real(*args)

            monkeypatch.setattr(folders, step, breaks)
            checkpoints = tmp_path / f"c-{step}-{fails_at}"
            with pytest.raises(StreamingQueryException):
                run(spark, source, path, checkpoints, busy=Busy(rows_per_state=10))
            monkeypatch.setattr(folders, step, real)
            again, _ = run(spark, source, path, checkpoints, busy=Busy(rows_per_state=10))
            assert again.last(spark) == whole.last(spark)
            for outcome in ("accepted", "rejected", "late"):
                got, want = again.read(spark, outcome), whole.read(spark, outcome)
                assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_states_are_few_and_counts_go_on(spark, tmp_path):
    source = str(tmp_path / "in")
    for i in range(23):
        send(spark, source, [(i, i, {}), (100 + i, i, "bad")])
    target, _ = run(spark, source, tmp_path / "out", tmp_path / "c")
    assert len(folders.names(spark, f"{tmp_path}/out/_state")) <= 21
    totals = target.last(spark)["totals"]
    assert totals == {"messages": 46, "accepted": 23, "rejected": 23, "late": 0}


def test_without_messages_there_are_folders_and_no_rows(spark, tmp_path):
    source = str(tmp_path / "in")
    send(spark, source, [])
    target, schema = run(spark, source, tmp_path / "out", tmp_path / "c")
    assert target.read(spark, "accepted").isEmpty() and target.last(spark).get("latest") is None
    rows = stream.stored_incidents(spark, target.folder("accepted"), schema)
    assert rows.isStreaming


def test_a_backlog_of_many_slots_is_not_taken_for_a_crowd(spark, tmp_path):
    """Eight slots in one micro-batch give the rate of a slot, also where sketches are short."""
    source, whole = str(tmp_path / "in"), str(tmp_path / "whole")
    crowd(spark, source, 8)
    spark.read.parquet(source).coalesce(1).write.parquet(whole)
    first = BASE // SLOT_SECONDS
    for slots in (72, 2):
        busy, place = Busy(rows_per_state=10, slots=slots), tmp_path / str(slots)
        target, _ = run(spark, whole, place / "out", place / "c", busy=busy)
        state = target.last(spark)
        assert [sketch["slot"] for sketch in state["sketches"]] == [first]
        assert state["cells"] == {"41.5_-87.75": [[first + 8, 4]]}
    # A second backlog begins a sketch of its own; the rate stays what it was.
    later = spark.read.parquet(whole).withColumn("timestamp", F.expr("timestamp + INTERVAL 80 MINUTES"))
    later.coalesce(1).write.mode("append").parquet(whole)
    target, _ = run(spark, whole, place / "out", place / "c", busy=busy)
    assert len(target.last(spark)["sketches"]) == 2
    assert target.last(spark)["cells"] == state["cells"]
