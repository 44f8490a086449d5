"""The plans are the ones meant: what is read, shuffled, broadcast."""

from pathlib import Path
from types import SimpleNamespace

import pytest

import __spark_entry__ as entry
from precinct.operators import records, reports
from precinct.operators.correlation import domestic_correlation
from precinct.operators.escalation import violence_escalation
from precinct.operators.hotspots import hotspots
from precinct.operators.patterns import historical_patterns, match_patterns
from precinct.operators.temporal import temporal_patterns
from precinct.plans import batch, scratch
from precinct.plans.scratch import release, scratch_root, stored
from precinct.sinks.jdbc import jdbc_options, write_jdbc
from precinct.sinks.files import write_curated
from precinct.sources import files, tables
from precinct.sources.streams import file_messages
from tests.conftest import SMALL


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def incidents(spark):
    return records.enrich(tables.events(spark, SMALL))


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curated") / "table")
    write_curated(tables.curated_orders(spark, SMALL), path, partition_by=["year"])
    return files.curated(spark, path)


def test_reports_read_only_their_columns(curated):
    plan = _plan(reports.by_location_and_type(curated))
    assert "ReadSchema: struct<primary_type:string,location_description:string>" in plan


def test_report_filters_reach_the_scan(curated):
    assert "In(primary_type" in _plan(reports.violent_trend(curated))
    assert "EqualTo(domestic,true)" in _plan(reports.domestic_arrests(curated))
    assert "PartitionFilters: [isnotnull(year" in _plan(curated.filter("year = 1996"))


def test_counts_are_combined_before_the_shuffle(curated):
    assert "partial_count" in _plan(reports.by_weekday(curated))


@pytest.mark.parametrize(
    "build", [hotspots, violence_escalation, temporal_patterns, domestic_correlation]
)
def test_no_python_and_no_cross_join(incidents, build):
    plan = _plan(build(incidents))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_windows_multiply_panes_not_rows(incidents):
    plan = _plan(violence_escalation(incidents))
    below_first_shuffle = plan.split("Exchange")[-1]
    assert "partial_count" in below_first_shuffle and "explode" not in below_first_shuffle
    assert plan.count("Exchange") == 2
    assert _plan(hotspots(incidents)).count("Exchange") == 2


def _executed(frame):
    """The plan that ran, after adaptive execution."""
    frame.toPandas()
    return _plan(frame).split("== Initial Plan ==")[0]


def test_spark_broadcasts_patterns_by_their_size(spark, incidents):
    patterns = stored(historical_patterns(incidents), "patterns")
    assert "BroadcastHashJoin" in _executed(match_patterns(incidents, patterns))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        assert "Broadcast" not in _executed(match_patterns(incidents, patterns))
    finally:
        spark.conf.set(threshold, before)


def test_the_query_for_the_shuffled_join_shuffles(spark):
    plan = _executed(entry._QUERIES["t2_pattern_shuffled"](spark, SMALL))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_key_with_most_incidents_is_split(spark, make_incidents):
    hot = [{"id": i, "type": "THEFT"} for i in range(6000)]
    rows = hot + [{"id": 6000 + i, "type": f"T{i % 50}"} for i in range(600)]
    incidents = make_incidents(rows).repartition(8)
    patterns = stored(historical_patterns(make_incidents(rows[-700:])), "patterns")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        matched = match_patterns(incidents, patterns)
        assert len(matched.toPandas()) == 6600
        assert "skew=true" in _plan(matched)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_deviations_come_from_panes(incidents):
    plan = _plan(temporal_patterns(incidents))
    assert "Expand" not in plan and plan.count("Exchange") == 2


def test_relational_writes_shuffle_before_the_connections(incidents):
    class Writer:
        def __getattr__(self, name):
            return lambda *args, **more: self

    dealt = []
    frame = SimpleNamespace(repartition=lambda n: dealt.append(n) or SimpleNamespace(write=Writer()))
    write_jdbc(frame, jdbc_options("jdbc:x", "t", "u", "p", "d", connections=5))
    assert dealt == [5]


def test_each_message_is_parsed_once(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    stream = records.incidents(file_messages(spark, str(tmp_path / "in")))
    hotspots(stream).explain()
    plan = capsys.readouterr().out
    assert plan.count("json_tuple") == 1 and "from_json" not in plan


def test_shared_folder_comes_from_the_session(spark, incidents):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    kept = stored(incidents.select("crime_id"), "kept")
    assert spark.conf.get("spark.checkpoint.dir") in kept.inputFiles()[0]


def test_scratch_folders_are_deleted_on_release(spark, incidents):
    kept = stored(incidents.select("crime_id"), "kept")
    folder = Path(kept.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists()
    release(SimpleNamespace(_jvm=spark._jvm, _jsc=spark._jsc, sparkContext=SimpleNamespace(applicationId="other")))
    assert folder.exists()
    made = list(scratch._made[spark.sparkContext.applicationId])
    scratch._made[spark.sparkContext.applicationId] = [p for p in made if folder.name in p]
    release(spark)
    scratch._made[spark.sparkContext.applicationId] = [p for p in made if folder.name not in p]
    assert not folder.exists()


def test_only_local_sessions_do_without_shared_folder():
    def session(master):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        conf = SimpleNamespace(get=lambda key, default: default)
        return SimpleNamespace(conf=conf, sparkContext=context)

    local = session("local[2]")
    assert scratch_root(local) == scratch_root(local)
    with pytest.raises(ValueError):
        scratch_root(session("spark://host:7077"))


def test_summary_is_stored_once(curated):
    built = batch.build_reports(curated)
    plan = _plan(built["crimes_by_location"])
    assert "report-summary" in plan


def test_relational_options():
    options = jdbc_options("jdbc:x", "t", "u", "p", "d", connections=3)
    assert options["numPartitions"] == "3" and options["truncate"] == "true"
    assert options["batchsize"] == "10000" and options["dbtable"] == "t"


def test_skewed_cells_are_split(spark, make_incidents):
    """A cell and slot with most rows is joined by several tasks, with the same pairs."""
    rows = [{"id": i, "at": i % 500, "domestic": i % 40 == 0} for i in range(6000)]
    rows += [{"id": 6000 + i, "at": i, "lat": 41.5 + i / 64, "domestic": i % 2 == 0} for i in range(400)]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    incidents = make_incidents(rows).repartition(8)
    expected = domestic_correlation(incidents).count()
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        pairs = domestic_correlation(incidents)
        assert len(pairs.toPandas()) == expected
        assert "skew=true" in _plan(pairs)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
