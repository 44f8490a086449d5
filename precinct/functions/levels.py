"""Labels chosen by conditions and thresholds."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: lowest count of each label, and the label below all ---
HOTSPOT_SEVERITY = (((5, "HIGH"), (3, "MEDIUM")), "LOW")
ESCALATION_RISK = (((4, "CRITICAL"), (2, "HIGH")), "NORMAL")
CRIME_INTENSITY = (((5, "VERY_HIGH"), (3, "HIGH"), (2, "MEDIUM")), "LOW")


def first_of(cases: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first condition that holds."""
    result = F.lit(otherwise)
    for condition, label in reversed(cases):
        result = F.when(condition, label).otherwise(result)
    return result


def level(count: Column, scale: tuple[Sequence[tuple[int, str]], str]) -> Column:
    """Label of the first threshold that ``count`` reaches."""
    steps, lowest = scale
    return first_of([(count >= threshold, label) for threshold, label in steps], lowest)
