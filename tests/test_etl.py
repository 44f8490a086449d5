"""Raw text to the curated table."""

from pyspark.sql import functions as F

from precinct.operators import etl
from precinct.plans import batch
from precinct.schema import CURATED
from precinct.sinks.files import write_curated
from precinct.sources import files

HEADER = "Block,ID,Case Number,Date,Primary Type,Description,Location Description,Arrest,Domestic,Latitude,Longitude,Ward"
LINES = [
    'B,1,HX1,01/05/2020 01:30:00 PM,THEFT,"FROM, BUILDING",STREET,true,false,41.5,-87.75,7',
    "B,2,HX2,garbage,BATTERY,SIMPLE,,maybe,Y,41.5,-87.75,7",
    "B,abc,HX3,07/05/2021 12:00:00 AM,ASSAULT,SIMPLE,STREET,false,true,41.5,-87.75,",
    "B,4,HX4,07/05/2021 12:00:00 AM,ASSAULT,SIMPLE,STREET,false,true,,-87.75,",
]


def _raw(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(path)


def test_columns_are_found_by_name_and_quotes_are_kept(spark, tmp_path):
    raw = etl.select_renamed(files.raw_csv(spark, _raw(tmp_path)))
    first = raw.filter("crime_id = '1'").first()
    assert first["description"] == "FROM, BUILDING"
    assert first["arrest"] == "true" and first["longitude"] == "-87.75"


def test_bad_text_gives_null_and_unlocated_rows_go(spark, tmp_path):
    curated = etl.curate(files.raw_csv(spark, _raw(tmp_path)))
    rows = {r["case_number"]: r for r in curated.collect()}
    assert set(rows) == {"HX1", "HX2", "HX3"}
    assert (rows["HX1"]["day_of_week"], rows["HX1"]["month"], rows["HX1"]["year"]) == ("Sunday", 1, 2020)
    assert rows["HX1"]["season"] == "Winter"
    undated = rows["HX2"]
    assert undated["date"] is None and undated["season"] == "Unknown" and undated["year"] is None
    assert undated["arrest"] is None and undated["domestic"] is True
    assert undated["location_description"] is None
    assert rows["HX3"]["crime_id"] is None


def test_curated_table_keeps_types(spark, tmp_path):
    curated = batch.build_curated(spark, _raw(tmp_path), str(tmp_path / "curated"))
    assert curated.schema == CURATED
    assert curated.count() == 3
    assert curated.filter(F.col("year") == 2020).count() == 1
    # A second run replaces the first.
    again = batch.build_curated(spark, _raw(tmp_path), str(tmp_path / "curated"))
    assert again.count() == 3


def test_curated_csv_round_trip(spark, tmp_path):
    curated = etl.curate(files.raw_csv(spark, _raw(tmp_path)))
    path = str(tmp_path / "csv")
    write_curated(curated, path, "csv")
    back = files.curated_csv(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, curated.collect()))
