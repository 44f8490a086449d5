"""Left outer equi-join of a large frame with a lookup table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    row_id: Sequence[str],
    salts: int = 1,
    strategy: str | None = None,
) -> DataFrame:
    """Every fact with all its lookup rows; facts without one are kept.

    Spark chooses the kind of join by the size of the lookup, unless ``strategy``
    names one. In batches, adaptive execution splits a key that holds many
    facts. (It can do so only for a side that is shuffled for the join, so the
    lookup should not come out of a grouping by the keys, but be stored.) On
    streams it does not: there ``salts`` spreads the facts of a key over so many
    tasks, and the lookup is copied as often.
    """
    on = list(keys)
    if salts > 1:
        salt = F.pmod(F.xxhash64(*row_id), F.lit(salts)).cast("int")
        facts = facts.withColumn("_salt", salt)
        lookup = lookup.withColumn("_salt", F.explode(F.lit(list(range(salts)))))
        on.append("_salt")
    if strategy:
        lookup = lookup.hint(strategy)
    return facts.join(lookup, on, "left").drop("_salt")
