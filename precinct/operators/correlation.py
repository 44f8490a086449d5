"""Domestic incidents joined to other incidents shortly before, in the same cell."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.functions import geo
from precinct.schema import CORRELATION_MINUTES

# Length of a time slot: a third of the interval.
SLOT_SECONDS = 60 * max(CORRELATION_MINUTES // 3, 1)
# State partitions that a busy (cell, slot) of a stream is spread over.
STREAM_SALTS = 8

_CARRIED = {
    "crime_id": "crime_id",
    "primary_type": "primary_type",
    "location_description": "location",
    "latitude": "latitude",
    "longitude": "longitude",
}


def slot_of(moment: Column, slot: int = SLOT_SECONDS) -> Column:
    return F.floor(F.unix_timestamp(moment) / slot)


def touched_slots(
    moment: Column, minutes: int = CORRELATION_MINUTES, slot: int = SLOT_SECONDS
) -> Column:
    """The slots of the interval that ends at ``moment``; its own slot is the last."""
    earliest = F.timestamp_add("MINUTE", F.lit(-minutes), moment)
    return F.sequence(slot_of(earliest, slot), slot_of(moment, slot))


def _side(
    incidents: DataFrame, wanted: Column, prefix: str, event_time: str, decimals: int
) -> DataFrame:
    """Rows of one side with prefixed names; rows without a cell can never match."""
    salts = F.col("cell_salts") if "cell_salts" in incidents.columns else F.lit(None)
    latitude, longitude = F.col("latitude"), F.col("longitude")
    cell_lat, cell_lon = geo.cell(latitude, longitude, decimals)
    return incidents.filter(wanted & geo.has_coordinates(latitude, longitude)).select(
        *[F.col(name).alias(f"{prefix}_{alias}") for name, alias in _CARRIED.items()],
        F.col(event_time).alias(f"{prefix}_event_time"),
        cell_lat.alias(f"{prefix}_cell_lat"),
        cell_lon.alias(f"{prefix}_cell_lon"),
        salts.cast("array<int>").alias(f"{prefix}_salts"),
    )


def domestic_correlation(
    incidents: DataFrame,
    event_time: str = "event_time",
    minutes: int = CORRELATION_MINUTES,
    decimals: int = 2,
    slot_minutes: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Pairs (domestic, other) with ``other <= domestic <= other + minutes``.

    Besides the cell, the pair is matched on a time slot: each domestic row, the
    rarer side, is copied into every slot its interval touches, and the other
    side stays in its own slot (a third of ``minutes`` long by default). A busy
    cell is thereby spread over the cluster by time and only neighbouring slots
    are ever compared. The exact time bounds remain part of the join condition;
    on streams they bound the state.

    ``salts`` splits each (cell, slot) of the other side further. Incidents that
    were ingested have ``cell_salts``, which do so for busy cells only: the
    copies of a row in any other cell are its slots. Other streams split all
    cells by default, as all rows of a cell and slot would share a state
    partition there. Batches leave that to the skew handling of adaptive
    execution.

    Ingested rows that were behind their ``watermark`` are left out.
    """
    by_cell = salts is None and "cell_salts" in incidents.columns
    if salts is None:
        salts = STREAM_SALTS if incidents.isStreaming else 1
    slot = 60 * (slot_minutes or max(minutes // 3, 1))
    if "watermark" in incidents.columns:
        in_time = F.col("watermark").isNull() | (F.col(event_time) > F.col("watermark"))
        incidents = incidents.filter(in_time)
    domestic = _side(incidents, F.col("domestic"), "d", event_time, decimals)
    others = _side(incidents, ~F.col("domestic"), "nd", event_time, decimals)

    d_time, nd_time = F.col("d_event_time"), F.col("nd_event_time")
    slots = F.posexplode(touched_slots(d_time, minutes, slot)).alias("d_place", "d_slot")
    domestic = domestic.select("*", slots)
    others = others.withColumn("nd_slot", slot_of(nd_time, slot))
    match = (
        (F.col("d_cell_lat") == F.col("nd_cell_lat"))
        & (F.col("d_cell_lon") == F.col("nd_cell_lon"))
        & (F.col("d_slot") == F.col("nd_slot"))
        & (d_time >= nd_time)
        & (d_time <= nd_time + F.expr(f"INTERVAL {minutes} MINUTES"))
    )
    d_salts, nd_salts = F.lit(salts), F.lit(salts)
    if by_cell:
        if (minutes, slot) != (CORRELATION_MINUTES, SLOT_SECONDS):
            raise ValueError("cell_salts belong to the slots of the default interval")
        d_salts = F.coalesce(F.try_element_at("d_salts", F.col("d_place") + 1), F.lit(1))
        nd_salts = F.coalesce(F.try_element_at("nd_salts", F.lit(-1)), F.lit(1))
    if by_cell or salts > 1:
        domestic = domestic.withColumn(
            "d_salt", F.explode(F.sequence(F.lit(0), d_salts - 1))
        )
        others = others.withColumn(
            "nd_salt", F.pmod(F.xxhash64("nd_crime_id", "nd_event_time"), nd_salts).cast("int")
        )
        match &= F.col("d_salt") == F.col("nd_salt")

    pairs = domestic.join(others, match, "inner")
    seconds = F.unix_timestamp(d_time) - F.unix_timestamp(nd_time)
    return pairs.select(
        "d_crime_id",
        "nd_crime_id",
        "d_primary_type",
        "nd_primary_type",
        "d_location",
        "nd_location",
        (seconds / 60).alias("time_diff_minutes"),
        geo.planar_distance(
            F.col("d_latitude"), F.col("d_longitude"), F.col("nd_latitude"), F.col("nd_longitude")
        ).alias("geographic_distance"),
        F.col("d_latitude").alias("correlation_lat"),
        F.col("d_longitude").alias("correlation_lon"),
        geo.cell_name(F.col("d_cell_lat"), F.col("d_cell_lon")).alias("geo_grid"),
    )
