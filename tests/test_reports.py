"""The batch reports."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from precinct.operators import reports
from precinct.plans import batch
from precinct.schema import CURATED
from precinct.sources import tables
from tests.conftest import SMALL

SHAPE = "year int, month int, day_of_week string, season string, primary_type string, location_description string, arrest boolean, domestic boolean"


def _curated(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def test_equal_totals_go_to_the_first_type(spark):
    rows = [(2020, 1, "Sunday", "Winter", kind, "STREET", True, False) for kind in ("B", "A", "B", "A", "C")]
    leader = reports.leading_type_per_year(_curated(spark, rows)).collect()
    assert [(r["year"], r["primary_type"], r["total_crimes"], r["rank"]) for r in leader] == [(2020, "A", 2, 1)]


def test_months_sort_by_number(spark):
    rows = [(2020, m, "Sunday", "Winter", "A", "STREET", True, False) for m in (12, 2, 10, 1)]
    assert [r["month"] for r in reports.by_month(_curated(spark, rows)).collect()] == [1, 2, 10, 12]


def test_null_domestic_is_not_domestic(spark):
    rows = [(2020, 1, "Sunday", "Winter", "A", "STREET", a, d)
            for a, d in ((True, True), (None, True), (True, None), (True, False))]
    found = {r["arrest"]: r["total_crimes"] for r in reports.domestic_arrests(_curated(spark, rows)).collect()}
    assert found == {None: 1, True: 1}


row = st.tuples(
    st.sampled_from([2019, 2020, None]), st.integers(1, 12), st.sampled_from(["Sunday", "Monday"]),
    st.sampled_from(["Winter", "Fall"]), st.sampled_from(["HOMICIDE", "THEFT", None]),
    st.sampled_from(["STREET", None]), st.sampled_from([True, False, None]),
    st.sampled_from([True, False, None]),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_totals_add_up_and_summary_changes_nothing(spark, rows):
    curated = _curated(spark, rows)
    summary = reports.summary(curated)
    for report in reports.CATEGORY_REPORTS.values():
        assert report(curated).collect() == report(summary).collect()
    for report in (reports.by_weekday, reports.by_month, reports.by_location):
        assert report(curated).agg(F.sum("total_crimes")).first()[0] == len(rows)


def test_all_reports_are_published(spark):
    seen = {}
    curated = tables.curated_orders(spark, SMALL)
    batch.publish_reports(curated, lambda frame, name: seen.update({name: frame.count()}))
    assert len(seen) == 11 and all(seen.values())
    assert seen["incidents"] == curated.count()


@pytest.mark.parametrize("name", reports.CATEGORY_REPORTS)
def test_stored_summary_gives_the_same_report(spark, name):
    curated = tables.curated_orders(spark, SMALL)
    direct = reports.CATEGORY_REPORTS[name](curated)
    assert batch.build_reports(curated)[name].collect() == direct.collect()


def test_patterns_table(spark, tmp_path):
    curated = tables.curated_orders(spark, SMALL)
    assert set(CURATED.fieldNames()) == set(curated.columns)
    stored = batch.build_patterns(curated, str(tmp_path / "patterns"))
    assert stored.agg(F.sum("historical_frequency")).first()[0] == curated.count()
