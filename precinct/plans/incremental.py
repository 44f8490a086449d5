"""Report totals that are kept by year: only years whose files changed are added up again."""

import hashlib
import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.operators import reports
from precinct.plans import folders
from precinct.sources import files

NO_YEAR = "__HIVE_DEFAULT_PARTITION__"

# What is kept, by name: a year's rows as totals, in columns that reports add up further.
KEPT: dict[str, Callable[[DataFrame], DataFrame]] = {
    "summary": reports.summary,
    "places": reports.place_totals,
}


class Kept(NamedTuple):
    """Where a year's totals lie, and what its files were like then."""

    fingerprint: str
    folder: str


def fingerprints(spark: SparkSession, curated_path: str) -> dict[str, str]:
    """By year, a digest of the names, sizes and times of the files below it."""
    found = {}
    for name in folders.names(spark, curated_path):
        if name.startswith("year="):
            seen = json.dumps(folders.listing(spark, f"{curated_path}/{name}"))
            found[name.removeprefix("year=")] = hashlib.sha256(seen.encode()).hexdigest()
    return found


def known(spark: SparkSession, path: str) -> tuple[int, dict[str, Kept]]:
    """The newest version of the totals, and its years."""
    numbers = [int(n.removesuffix(".json")) for n in folders.names(spark, f"{path}/_log") if n[0] != "."]
    if not numbers:
        return 0, {}
    text = json.loads(folders.read_text(spark, f"{path}/_log/{max(numbers):012d}.json"))
    return max(numbers), {year: Kept(*kept) for year, kept in text.items()}


def refresh(spark: SparkSession, curated_path: str, path: str) -> list[str]:
    """Bring the totals of ``path`` up to the curated table; returns the years added up anew.

    They go into a new folder and a new version of the list of years, which appears
    whole or not at all. Years that are gone leave the list. Folders of earlier
    versions stay while the version before the newest names them.
    """
    number, before = known(spark, path)
    now = fingerprints(spark, curated_path)
    changed = sorted(y for y, seen in now.items() if y not in before or before[y].fingerprint != seen)
    if not changed and now.keys() == before.keys():
        return []
    run = f"run-{uuid.uuid4().hex}"
    if changed:
        rows = of_years(files.curated(spark, curated_path), changed)
        for name, build in KEPT.items():
            # The year stays in the rows; the copy names the folder.
            totals = build(rows).withColumn("of_year", F.col("year"))
            totals.write.partitionBy("of_year").parquet(f"{path}/{run}/{name}")
    after = {y: kept for y, kept in before.items() if y in now and y not in changed}
    for year in changed:
        # Files without rows give no totals.
        has_rows = folders.exists(spark, f"{path}/{run}/summary/of_year={year}")
        after[year] = Kept(now[year], run if has_rows else "")
    if not folders.write_text(spark, f"{path}/_log/{number + 1:012d}.json", json.dumps(after)):
        folders.remove(spark, f"{path}/{run}")
        raise RuntimeError(f"{path} was refreshed by someone else at the same time")
    _clear(spark, path, number, {kept.folder for kept in (*before.values(), *after.values())})
    return changed


def _clear(spark: SparkSession, path: str, number: int, used: set[str]) -> None:
    for name in folders.names(spark, path):
        if name.startswith("run-") and name not in used:
            folders.remove(spark, f"{path}/{name}")
    folders.remove(spark, f"{path}/_log/{number - 1:012d}.json")


def of_years(curated: DataFrame, years: list[str]) -> DataFrame:
    """Rows of some years; the scan reads their folders only."""
    numbers = [int(y) for y in years if y != NO_YEAR]
    wanted = F.col("year").isin(numbers)
    return curated.filter(wanted | F.col("year").isNull() if NO_YEAR in years else wanted)


def totals(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The kept totals of all years."""
    _, years = known(spark, path)
    paths = [f"{path}/{k.folder}/{name}/of_year={year}" for year, k in years.items() if k.folder]
    if not paths:
        raise ValueError(f"no totals in {path}")
    return spark.read.parquet(*paths)


def build_reports(spark: SparkSession, curated_path: str, path: str) -> dict[str, DataFrame]:
    """All ten reports from refreshed totals; they equal those of a full build."""
    refresh(spark, curated_path, path)
    summary = totals(spark, path, "summary")
    built = {name: report(summary) for name, report in reports.CATEGORY_REPORTS.items()}
    built[reports.GEOGRAPHIC_REPORT] = reports.geographic_distribution(totals(spark, path, "places"))
    return built
