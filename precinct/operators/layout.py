"""A layout of curated incidents in which near places and months lie together.

Rows are ordered by a space-filling curve over cell and month: the bits of latitude,
longitude and month, scaled to equal ranges, are interleaved into one number. A run of that
order is a small box in all three, so the statistics of a row group are narrow in each, and a
query for a box skips nearly all groups, whichever of the columns it names.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 16


class Box(NamedTuple):
    """A range of places and months; ``None`` is open."""

    south: float | None = None
    north: float | None = None
    west: float | None = None
    east: float | None = None
    first_month: int | None = None
    last_month: int | None = None


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """One number from the lower ``bits`` of several, bit by bit in turn, the highest first."""
    if bits * len(numbers) > 63:
        raise ValueError("more bits than a number holds")
    out = F.lit(0).cast("bigint")
    for at in range(bits):
        for turn, number in enumerate(numbers):
            bit = F.shiftright(number.cast("bigint"), at).bitwiseAND(F.lit(1).cast("bigint"))
            out = out.bitwiseOR(F.shiftleft(bit, at * len(numbers) + len(numbers) - 1 - turn))
    return out


def _scaled(value: Column, low: float | None, high: float | None, bits: int) -> Column:
    """``low`` to ``high`` as 0 to 2 ** bits - 1; null goes to 0."""
    if low is None or high == low:
        return F.lit(0)
    share = (value.cast("double") - F.lit(float(low))) / F.lit(float(high - low))
    most = (1 << bits) - 1
    inside = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))
    return F.coalesce(F.floor(inside * most), F.lit(0))


def curve(rows: DataFrame, names: Sequence[str], bits: int = BITS) -> Column:
    """Place on the curve through the ranges that the columns have in ``rows``; one pass."""
    known = rows.agg(*(f(F.col(n)).alias(f"{f.__name__}_{n}") for n in names for f in (F.min, F.max)))
    found = known.first()
    return interleaved(
        [_scaled(F.col(n), found[f"min_{n}"], found[f"max_{n}"], bits) for n in names], bits
    )


def laid_out(curated: DataFrame, rows_per_file: int | None = None) -> DataFrame:
    """``curated`` dealt and sorted along the curve, by ranges, so that no task gets a hot cell.

    Rows of one place and month are dealt on by their id. Write it without another shuffle.
    """
    order = curve(curated, ["latitude", "longitude", "month"])
    placed = curated.withColumn("_curve", order)
    keys = ["year", "_curve", "crime_id"]
    if rows_per_file:
        many = max(1, -(-curated.count() // rows_per_file))
        dealt = placed.repartitionByRange(many, *keys)
    else:
        dealt = placed.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys).drop("_curve")


def inside(curated: DataFrame, box: Box) -> DataFrame:
    """Incidents in a box, by plain comparisons that reach the scan."""
    for name, low, high in (
        ("latitude", box.south, box.north),
        ("longitude", box.west, box.east),
        ("month", box.first_month, box.last_month),
    ):
        if low is not None:
            curated = curated.filter(F.col(name) >= low)
        if high is not None:
            curated = curated.filter(F.col(name) <= high)
    return curated
