"""File scans and literal relations."""

from pyspark.sql import DataFrame, SparkSession

from precinct.schema import CURATED


def raw_csv(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> DataFrame:
    """Raw records with a header line, all text; quoted fields may contain the delimiter.

    Each path (a file, or a folder of files with one header) is planned from its
    own header and columns are put together by name, so paths may differ in the
    order of their columns. Headers are checked when files are read: a file
    whose header differs from that of its path ends the job.
    """
    paths = [path] if isinstance(path, str) else path
    reader = spark.read.options(header=True, sep=delimiter, escape='"', enforceSchema=False)
    whole = reader.csv(paths[0])
    for each in paths[1:]:
        whole = whole.unionByName(reader.csv(each))
    return whole


def curated(spark: SparkSession, path: str) -> DataFrame:
    """The typed table written by the ETL; types are not re-read from text."""
    return spark.read.schema(CURATED).parquet(path).select(CURATED.fieldNames())


def curated_csv(spark: SparkSession, path: str) -> DataFrame:
    """The typed table from CSV files in its column order."""
    return spark.read.schema(CURATED).option("header", True).csv(path)


# --- fixed values: the two literal pattern rows (type, place, lat, lon) ---
INLINE_PATTERNS = (
    ("THEFT", "STREET", 41.8781, -87.6298),
    ("BATTERY", "RESIDENCE", 41.8818, -87.6231),
)


def inline_history(spark: SparkSession, moment: str | None = None) -> DataFrame:
    """A literal two-row history at ``moment`` (text) or now."""
    at = f"TIMESTAMP '{moment}'" if moment else "current_timestamp()"
    rows = " UNION ALL ".join(
        f"SELECT '{kind}' AS primary_type, '{place}' AS location_description, "
        f"{at} AS crime_date, {lat}D AS latitude, {lon}D AS longitude"
        for kind, place, lat, lon in INLINE_PATTERNS
    )
    return spark.sql(rows)
