import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from precinct.operators.records import enrich  # noqa: E402
from precinct.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"

INCIDENT = (
    "crime_id bigint, crime_date timestamp, primary_type string, location_description string, "
    "arrest boolean, domestic boolean, latitude double, longitude double, event_time timestamp"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture
def make_incidents(spark):
    """Enriched incidents from partial rows; times are seconds after 10:00:00."""

    def make(rows):
        base = datetime(2024, 2, 1, 10, 0, 0)
        full = []
        for i, row in enumerate(rows):
            seconds = row.get("at", 0)
            moment = datetime.fromtimestamp(base.timestamp() + seconds)
            full.append(
                (
                    row.get("id", i),
                    row.get("occurred", moment),
                    row.get("type", "THEFT"),
                    row.get("place", "STREET"),
                    row.get("arrest", False),
                    row.get("domestic", False),
                    row.get("lat", 41.5),
                    row.get("lon", -87.75),
                    moment,
                )
            )
        return enrich(spark.createDataFrame(full, INCIDENT))

    return make
