"""Hotspot detection: dense grid cells per sliding window."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.functions import geo
from precinct.functions.levels import HOTSPOT_SEVERITY, level
from precinct.operators.sliding import (
    gathered,
    sliding_entries,
    sliding_totals,
    with_watermark,
)

_CELL = ["cell_lat", "cell_lon"]
_KIND = "primary_type"


def hotspots(
    incidents: DataFrame,
    event_time: str = "event_time",
    length: int = 5,
    slide: int = 1,
    decimals: int = 2,
    min_count: int = 2,
    types: str = "counts",
) -> DataFrame:
    """Cells with at least ``min_count`` located incidents in a window.

    Shuffle and state hold one counter per (window, cell, type), never a list
    that grows with the cell. ``types="counts"`` gives them as a map from type to
    count; ``types="list"`` writes them out as the sorted list of all types,
    which has an element for each incident of the cell: it is for cells that one
    row can list. The counters also give the number of types exactly, without a
    sketch per group.
    """
    located = _located(incidents, event_time, decimals)
    cells = sliding_entries(located, event_time, length, slide, _CELL, _KIND, _sums())
    return _dense(cells, min_count, types)


def hotspot_counts(
    incidents: DataFrame,
    event_time: str = "event_time",
    length: int = 5,
    slide: int = 1,
    decimals: int = 2,
) -> DataFrame:
    """Counters per (window, cell, type): the part of ``hotspots`` a stream keeps as state."""
    located = _located(incidents, event_time, decimals)
    return sliding_totals(located, event_time, length, slide, [*_CELL, _KIND], _sums())


def hotspots_from_counts(counts: DataFrame, min_count: int = 2, types: str = "counts") -> DataFrame:
    """Hotspots from all counters of their windows.

    A stream puts out the counters of a window together, in the micro-batch that
    closes it. Finishing them there saves the second state store that grouping
    the stream itself would need.
    """
    return _dense(gathered(counts, _CELL, _KIND), min_count, types)


def _located(incidents: DataFrame, event_time: str, decimals: int) -> DataFrame:
    latitude, longitude = F.col("latitude"), F.col("longitude")
    cell_lat, cell_lon = geo.cell(latitude, longitude, decimals)
    return incidents.filter(geo.has_coordinates(latitude, longitude)).select(
        event_time,
        *with_watermark(incidents),
        _KIND,
        latitude,
        longitude,
        cell_lat.alias("cell_lat"),
        cell_lon.alias("cell_lon"),
    )


def _sums() -> dict[str, Column]:
    return {"n": F.count("*"), "lat_sum": F.sum("latitude"), "lon_sum": F.sum("longitude")}


def _dense(cells: DataFrame, min_count: int, types: str) -> DataFrame:
    counted = cells.withColumn("crime_count", _total("n", F.lit(0).cast("bigint")))
    return counted.filter(F.col("crime_count") >= min_count).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        geo.cell_name(F.col("cell_lat"), F.col("cell_lon")).alias("geo_grid"),
        (_total("lat_sum", F.lit(0.0)) / F.col("crime_count")).alias("avg_lat"),
        (_total("lon_sum", F.lit(0.0)) / F.col("crime_count")).alias("avg_lon"),
        "crime_count",
        F.size(_types()).cast("bigint").alias("crime_variety"),
        level(F.col("crime_count"), HOTSPOT_SEVERITY).alias("hotspot_severity"),
        _TYPE_FORMS[types]().alias("crime_types"),
        F.current_timestamp().alias("analysis_timestamp"),
    )


def _total(name: str, zero: Column) -> Column:
    return F.aggregate("entries", zero, lambda total, e: total + e[name])


def _types() -> Column:
    """The types that occur, without null."""
    return F.array_distinct(F.array_compact(F.col("entries.primary_type")))


def _type_list() -> Column:
    named = F.filter("entries", lambda e: e["primary_type"].isNotNull())
    repeated = F.transform(
        F.array_sort(F.transform(named, lambda e: F.struct(e["primary_type"], e["n"]))),
        lambda e: F.transform(
            F.sequence(F.lit(1).cast("bigint"), e["n"]), lambda _: e["primary_type"]
        ),
    )
    return F.flatten(repeated)


def _type_counts() -> Column:
    def count(name: Column) -> Column:
        own = F.filter("entries", lambda e: e["primary_type"] == name)
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda total, e: total + e["n"])

    return F.map_from_arrays(_types(), F.transform(_types(), count))


_TYPE_FORMS = {"list": _type_list, "counts": _type_counts}
