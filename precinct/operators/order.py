"""The position of rows in a sorted frame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.plans.scratch import stored

# Spark numbers the rows of a partition in so many of the lower bits.
_PLACE_BITS = 33


def with_position(ordered: DataFrame, name: str = "position") -> DataFrame:
    """Rows of a globally sorted frame with their position from 0.

    A sort deals ranges to numbered partitions, so a position is the row's place in
    its partition after the rows of all partitions before. The sorted rows are
    stored, as their partitions must not change between counting and numbering;
    the driver gets a count per partition, and no task gets all rows.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    marked = ordered.select("*", F.spark_partition_id().alias("_part"), place.alias("_place"))
    kept = stored(marked, "ordered")
    starts, rows = [], 0
    for part, count in sorted(map(tuple, kept.groupBy("_part").count().collect())):
        starts.append((part, rows))
        rows += count
    spark = ordered.sparkSession
    offsets = spark.createDataFrame(starts, "_part int, _start bigint")
    # As many rows as the sort had partitions.
    numbered = kept.join(F.broadcast(offsets), "_part")
    return numbered.select(*ordered.columns, (F.col("_place") + F.col("_start")).alias(name))
