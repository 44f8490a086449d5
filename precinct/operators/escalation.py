"""Violence escalation per zone and sliding window."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.functions import geo
from precinct.functions.levels import ESCALATION_RISK, level
from precinct.operators.sliding import sliding_totals, with_watermark
from precinct.schema import VIOLENT_TYPES


def violence_escalation(
    incidents: DataFrame,
    event_time: str = "event_time",
    length: int = 10,
    slide: int = 2,
    decimals: int = 1,
) -> DataFrame:
    """Counts, outcomes and risk of violent incidents; unlocated ones share a null zone.

    Only the four violent types can occur, so one counter per type gives the
    number of types exactly and the whole group state is a row of sums.
    """
    latitude, longitude = F.col("latitude"), F.col("longitude")
    zone_lat, zone_lon = geo.cell(latitude, longitude, decimals)
    violent = incidents.filter("is_violent").select(
        event_time,
        *with_watermark(incidents),
        "primary_type",
        "arrest",
        latitude,
        longitude,
        zone_lat.alias("cell_lat"),
        zone_lon.alias("cell_lon"),
    )
    per_type = {f"n_{name}": F.count_if(F.col("primary_type") == name) for name in VIOLENT_TYPES}
    zones = sliding_totals(
        violent,
        event_time,
        length,
        slide,
        keys=["cell_lat", "cell_lon"],
        sums={
            **per_type,
            "violent_incidents": F.count("*"),
            "arrests_made": F.count_if("arrest"),
            "lat_sum": F.sum("latitude"),
            "lat_n": F.count("latitude"),
            "lon_sum": F.sum("longitude"),
            "lon_n": F.count("longitude"),
        },
    )
    kinds = sum((F.col(name) > 0).cast("bigint") for name in per_type)
    share = F.col("arrests_made") / F.col("violent_incidents")
    return zones.select(
        F.col("window.start").alias("period_start"),
        F.col("window.end").alias("period_end"),
        geo.cell_name(F.col("cell_lat"), F.col("cell_lon")).alias("geo_zone"),
        F.try_divide("lat_sum", "lat_n").alias("zone_lat"),
        F.try_divide("lon_sum", "lon_n").alias("zone_lon"),
        "violent_incidents",
        kinds.alias("violence_types"),
        F.col("n_HOMICIDE").alias("homicides"),
        F.col("n_ASSAULT").alias("assaults"),
        "arrests_made",
        F.round(share * 100, 2).alias("arrest_effectiveness"),
        level(F.col("violent_incidents"), ESCALATION_RISK).alias("escalation_risk"),
    )
