"""The jobs as they are started from the command line."""

import sys

import pytest

from precinct import __main__ as cli
from precinct.operators import reports
from precinct.plans import batch
from precinct.schema import CURATED
from precinct.sinks.files import write_curated
from precinct.sources import tables
from tests.conftest import SMALL


@pytest.fixture
def run(monkeypatch):
    def start(*args):
        monkeypatch.setattr(sys, "argv", ["precinct", *args])
        cli.main()

    return start


def test_all_jobs(spark, run, tmp_path):
    path = {name: str(tmp_path / name) for name in ("raw", "curated", "out", "patterns", "topic")}
    raw = tables.raw_orders(spark, SMALL)
    write_curated(raw, path["raw"], "csv")

    run("etl", "--raw", path["raw"], "--curated", path["curated"], "--show")
    curated = spark.read.schema(CURATED).parquet(path["curated"])
    assert 0 < curated.count() < raw.count()

    run("reports", "--curated", path["curated"], "--out", path["out"])
    for name in [*reports.CATEGORY_REPORTS, reports.GEOGRAPHIC_REPORT]:
        assert spark.read.parquet(f"{path['out']}/{name}").count() > 0

    with pytest.raises(SystemExit):
        run("reports", "--curated", path["curated"])
    with pytest.raises(SystemExit):
        run("reports", "--curated", path["curated"], "--jdbc-url", "jdbc:x")

    run("patterns", "--curated", path["curated"], "--out", path["patterns"])
    reader = batch.current_patterns(spark, path["patterns"])
    run("patterns", "--curated", path["curated"], "--out", path["patterns"])
    assert batch.versions(spark, path["patterns"]) == [1, 2]
    # A job that began before the rebuild still reads its version.
    assert reader.count() == batch.current_patterns(spark, path["patterns"]).count() > 0
    run("publish", "--raw", path["raw"], "--out", path["topic"])
    assert spark.read.parquet(path["topic"]).count() == raw.count()

    run("stream", "--messages", path["topic"], "--patterns", path["patterns"],
        "--out", path["out"], "--checkpoints", str(tmp_path / "checkpoints"), "--once", "--console",
        "--correlation-salts", "2")
    matched = spark.read.parquet(f"{path['out']}/stream_pattern_analysis")
    assert matched.select("crime_id").distinct().count() == raw.filter("Date LIKE '%M' AND Date NOT LIKE '1/5%'").count()
    assert spark.read.parquet(f"{path['out']}/stream_domestic_correlation").count() > 0

    # The same into a store; a file format stands for the connector.
    run("stream", "--messages", path["topic"], "--patterns", path["patterns"],
        "--out", str(tmp_path / "out2"), "--checkpoints", str(tmp_path / "checkpoints2"), "--once",
        "--store", "json", "--store-option", f"path={tmp_path}/store/{{collection}}")
    kept = spark.read.json(f"{tmp_path}/store/stream_pattern_analysis")
    assert kept.count() == kept.select("_id").distinct().count() == matched.count()
