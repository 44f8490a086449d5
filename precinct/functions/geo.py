"""Planar geography on degrees."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed value: metres per degree used for planar distances ---
METRES_PER_DEGREE = 111000


def has_coordinates(latitude: Column, longitude: Column) -> Column:
    return latitude.isNotNull() & longitude.isNotNull()


def cell(latitude: Column, longitude: Column, decimals: int) -> tuple[Column, Column]:
    """Rounded coordinates; both null when one is.

    Grouping and joining use these numbers; ``cell_name`` turns them into text
    only for the results.
    """
    known = has_coordinates(latitude, longitude)
    return (
        F.when(known, F.round(latitude, decimals)),
        F.when(known, F.round(longitude, decimals)),
    )


def cell_name(cell_latitude: Column, cell_longitude: Column) -> Column:
    """``<lat>_<lon>`` of a cell; null for the cell without coordinates."""
    return F.concat(cell_latitude.cast("string"), F.lit("_"), cell_longitude.cast("string"))


def grid_key(latitude: Column, longitude: Column, decimals: int) -> Column:
    """Name of the cell a point falls into."""
    return cell_name(*cell(latitude, longitude, decimals))


def planar_distance(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Straight-line distance in metres, treating degrees as a flat grid."""
    return F.sqrt(F.pow(lat_a - lat_b, 2) + F.pow(lon_a - lon_b, 2)) * METRES_PER_DEGREE


def dispersion(lat_spread: Column, lon_spread: Column) -> Column:
    """Length of the spread vector; 0.0 when a spread is undefined (one row)."""
    undefined = lat_spread.isNull() | lon_spread.isNull()
    return F.when(undefined, 0.0).otherwise(
        F.sqrt(F.pow(lat_spread, 2) + F.pow(lon_spread, 2))
    )
