"""Data skipping by the layout, positions without one task, and totals kept by year."""

import math
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from precinct.operators import layout, reports
from precinct.operators.order import with_position
from precinct.plans import batch, folders, incremental
from precinct.schema import CURATED
from precinct.sinks.files import write_curated
from precinct.sources import files, tables
from tests.conftest import SMALL


def incidents(spark, n, seed=1):
    """Places and months independent of each other, over three years."""
    rows = spark.range(n).select(
        F.col("id").alias("crime_id"),
        F.concat(F.lit("C"), F.col("id")).alias("case_number"),
        F.timestamp_seconds(1577836800 + (F.rand(seed) * 3 * 365 * 86400).cast("long")).alias("date"),
        F.element_at(F.array(F.lit("THEFT"), F.lit("ASSAULT"), F.lit("ARSON")), (F.rand(seed + 1) * 3).cast("int") + 1).alias("primary_type"),
        F.lit("d").alias("description"),
        F.lit("STREET").alias("location_description"),
        (F.rand(seed + 2) < 0.5).alias("arrest"),
        (F.rand(seed + 3) < 0.5).alias("domestic"),
        (41 + F.rand(seed + 4)).alias("latitude"),
        (-88 + F.rand(seed + 5)).alias("longitude"),
    )
    full = rows.withColumns(
        {
            "day_of_week": F.date_format("date", "EEEE"),
            "month": F.month("date"),
            "year": F.year("date"),
            "season": F.lit("Unknown"),
        }
    )
    return full.select(CURATED.fieldNames()).cache()


BOX = layout.Box(41.2, 41.4, -87.9, -87.7, 4, 6)


def groups(path, box):
    """Row groups of a table, and those whose statistics do not rule the box out."""
    every = needed = 0
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for i in range(meta.num_row_groups):
            every += 1
            columns = (meta.row_group(i).column(j) for j in range(meta.num_columns))
            stats = {c.path_in_schema: c.statistics for c in columns}
            needed += all(
                stats[name].max >= low and stats[name].min <= high
                for name, low, high in (
                    ("latitude", box.south, box.north),
                    ("longitude", box.west, box.east),
                    ("month", box.first_month, box.last_month),
                )
            )
    return every, needed


def test_a_box_reads_few_row_groups(spark, tmp_path):
    curated = incidents(spark, 60_000)
    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    size = {"parquet.block.size": "16384", "parquet.page.row.count.limit": "500",
            "parquet.block.row.count.limit": "1000"}
    curated.repartition(12, "crime_id").write.options(**size).partitionBy("year").parquet(plain)
    batch.store_laid_out(curated, laid, rows_per_file=5_000, **size)
    found = layout.inside(files.curated(spark, laid), BOX)
    want = layout.inside(curated, BOX)
    assert found.count() == want.count() > 100
    assert found.exceptAll(want).isEmpty()
    all_plain, read_plain = groups(plain, BOX)
    all_laid, read_laid = groups(laid, BOX)
    # Without the layout, only what is left over at the end of a file can be skipped.
    assert all_laid >= 20 and read_plain >= 0.95 * all_plain
    assert read_laid <= 0.25 * all_laid
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(latitude" in plan
    # Any one of the columns alone skips groups, too.
    for part in (layout.Box(41.2, 41.3, -90, -80, 1, 12), layout.Box(40, 42, -90, -80, 2, 2)):
        assert groups(laid, part)[1] <= 0.6 * all_laid


def test_interleaved_bits(spark):
    cases = [(a, b, c) for a in (0, 1, 5, 15) for b in (0, 2, 9) for c in (0, 7, 15)]
    frame = spark.createDataFrame(cases, "a int, b bigint, c int")
    number = layout.interleaved([F.col("a"), F.col("b"), F.col("c")], bits=4)
    for a, b, c, got in frame.select("*", number.alias("z")).collect():
        bits = "".join(x for triple in zip(f"{a:04b}", f"{b:04b}", f"{c:04b}") for x in triple)
        assert got == int(bits, 2)
    with pytest.raises(ValueError):
        layout.interleaved([F.col("a")] * 4, bits=16)


def test_layout_bears_nulls_one_value_and_no_rows(spark, tmp_path):
    curated = tables.curated_orders(spark, SMALL)
    odd = curated.withColumns(
        {"month": F.lit(None).cast("int"), "latitude": F.lit(41.5), "longitude": F.when(F.col("crime_id") % 2 == 0, F.col("longitude"))}
    )
    for n, frame in enumerate((odd, odd.limit(0), curated)):
        path = str(tmp_path / str(n))
        batch.store_laid_out(frame, path, rows_per_file=100)
        if n != 1:
            assert files.curated(spark, path).exceptAll(frame).isEmpty()
            assert files.curated(spark, path).count() == frame.count()
    assert layout.inside(curated, layout.Box()).count() == curated.count()


def test_positions_come_from_many_tasks(spark):
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("x"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = with_position(rows.orderBy(F.desc("x")))
        assert numbered.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    got = [tuple(r) for r in numbered.orderBy("position").collect()]
    want = sorted((r["x"] for r in rows.collect()), reverse=True)
    assert got == list(zip(want, range(len(want))))
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert with_position(rows.limit(0).orderBy("x")).count() == 0


def test_leaders_without_sorting_groups(spark):
    curated = tables.curated_orders(spark, SMALL)
    for report in (reports.leading_type_per_year, reports.leading_type_per_season):
        found = report(curated)
        assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.columns[1:] == ["primary_type", "total_crimes", "rank"]


def as_rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_only_changed_years_are_added_up(spark, tmp_path):
    curated = incidents(spark, 4_000, seed=9)
    path, kept = str(tmp_path / "curated"), str(tmp_path / "totals")
    write_curated(curated.filter("year < 2022"), path, partition_by=["year"])
    assert incremental.refresh(spark, path, kept) == ["2020", "2021"]
    assert incremental.refresh(spark, path, kept) == []

    def check(expected):
        built = incremental.build_reports(spark, path, kept)
        full = batch.build_reports(expected)
        assert built.keys() == full.keys()
        for name in full:
            assert as_rows(built[name]) == as_rows(full[name])

    check(curated.filter("year < 2022"))
    # One year is appended, and an undated record.
    curated.filter("year = 2022").drop("year").write.parquet(f"{path}/year=2022")
    undated = curated.limit(1).withColumns({"date": F.lit(None).cast("timestamp"), "month": F.lit(None).cast("int")})
    undated.drop("year").write.parquet(f"{path}/year={incremental.NO_YEAR}")
    for years in (["2022"], ["2022", incremental.NO_YEAR]):
        scan = incremental.of_years(files.curated(spark, path), years)
        # The year decides which folders are read, before any row is.
        plan = scan._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ (IN \(2022\)|= 2022)", plan)
        read = scan.select(F.input_file_name().alias("f")).distinct().collect()
        assert {Path(r["f"]).parent.name for r in read} == {f"year={y}" for y in years}
    assert incremental.refresh(spark, path, kept) == ["2022", incremental.NO_YEAR]
    everything = curated.unionByName(undated.withColumn("year", F.lit(None).cast("int")))
    check(everything)
    # One year is written anew, one goes.
    curated.filter("year = 2020 AND arrest").drop("year").write.mode("overwrite").parquet(f"{path}/year=2020")
    folders.remove(spark, f"{path}/year=2021")
    assert incremental.refresh(spark, path, kept) == ["2020"]
    check(everything.filter("(year = 2020 AND arrest) OR year = 2022 OR year IS NULL"))
    assert len([n for n in folders.names(spark, kept) if n.startswith("run-")]) <= 3


def test_totals_of_empty_tables_and_two_refreshes(spark, tmp_path, monkeypatch):
    path, kept = str(tmp_path / "curated"), str(tmp_path / "totals")
    curated = incidents(spark, 50, seed=3)
    curated.filter("year = 2020").drop("year").limit(0).write.parquet(f"{path}/year=2020")
    assert incremental.refresh(spark, path, kept) == ["2020"]
    with pytest.raises(ValueError):
        incremental.totals(spark, kept, "summary")
    curated.filter("year = 2021").drop("year").write.parquet(f"{path}/year=2021")
    # Another refresh commits first.
    real = folders.write_text
    monkeypatch.setattr(folders, "write_text", lambda *args: real(*args) and real(*args))
    with pytest.raises(RuntimeError):
        incremental.refresh(spark, path, kept)
    assert math.isclose(len([n for n in folders.names(spark, kept) if n.startswith("run-")]), 1, abs_tol=1)
