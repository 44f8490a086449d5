"""Batch jobs: raw files to the curated table, curated table to the reports."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from precinct.operators import etl, layout, patterns, reports
from precinct.plans.scratch import stored
from precinct.sinks.files import write_curated
from precinct.sources import files

VERSION = "version-"


def build_curated(
    spark: SparkSession, raw_path: str, curated_path: str, lay_out: bool = False
) -> DataFrame:
    """Curate raw CSV files into Parquet partitioned by year; one pass.

    ``lay_out`` sorts each year along a curve over place and month, for queries
    of small areas; that takes a pass more, for the ranges of the columns.
    """
    curated = etl.curate(files.raw_csv(spark, raw_path))
    if lay_out:
        store_laid_out(curated, curated_path)
    else:
        write_curated(curated, curated_path, partition_by=["year"])
    return files.curated(spark, curated_path)


def store_laid_out(
    curated: DataFrame, path: str, rows_per_file: int | None = None, **options: str
) -> None:
    """Write curated incidents by year, laid out along the curve; ``options`` are the writer's."""
    writer = layout.laid_out(curated, rows_per_file).write.mode("overwrite").options(**options)
    writer.partitionBy("year").parquet(path)


def build_reports(curated: DataFrame) -> dict[str, DataFrame]:
    """All ten reports; the incidents are scanned twice, however many reports are read.

    Nine reports add up one stored summary of row counts, whose size is bounded
    by the category vocabulary and not by the number of incidents.
    """
    totals = stored(reports.summary(curated), "report-summary")
    built = {name: report(totals) for name, report in reports.CATEGORY_REPORTS.items()}
    built[reports.GEOGRAPHIC_REPORT] = reports.geographic_distribution(curated)
    return built


def publish_reports(
    curated: DataFrame,
    write: Callable[[DataFrame, str], None],
    incidents_table: str = "incidents",
    built: dict[str, DataFrame] | None = None,
) -> None:
    """Hand every report, and the incidents themselves, to ``write(frame, table)``.

    ``built`` are the reports, if they are there already.
    """
    for name, report in (built or build_reports(curated)).items():
        write(report, name)
    write(curated, incidents_table)


def build_patterns(curated: DataFrame, path: str, per_location: bool = True) -> DataFrame:
    """Store the historical patterns that the stream is matched against.

    Each call writes a new version next to the older ones, which stay for the
    jobs that read them; a stream goes over to the newest when it is restarted.
    """
    found = patterns.historical_patterns(curated, "date", per_location)
    number = max(versions(curated.sparkSession, path), default=0) + 1
    found.write.parquet(f"{path}/{VERSION}{number:09d}")
    return current_patterns(curated.sparkSession, path)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions below ``path`` that are complete, the oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    paths = [entry.getPath() for entry in system.listStatus(folder)]
    return sorted(
        int(each.getName().removeprefix(VERSION))
        for each in paths
        if each.getName().startswith(VERSION) and system.exists(hadoop.Path(each, "_SUCCESS"))
    )


def current_patterns(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of the patterns."""
    number = max(versions(spark, path), default=None)
    if number is None:
        raise ValueError(f"no patterns in {path}")
    return spark.read.parquet(f"{path}/{VERSION}{number:09d}")
