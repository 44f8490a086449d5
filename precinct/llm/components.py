"""Connected components of links, as joins and groupings of tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.plans.scratch import discard, stored


def components(links: DataFrame) -> DataFrame:
    """``id component``: the smallest id that each linked id reaches; links are ``a b``.

    Each round gives a node the smallest name around it and then the name of its name, so
    that chains halve. Names are grouped before they are shuffled, so a node may have any
    number of links. Ids without links are not in the result.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    edges = stored(both, "links")
    names = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least"))
    names = stored(names.select("id", F.least("id", "least").alias("component")), "names")
    while True:
        near = edges.join(names, edges["b"] == names["id"]).groupBy("a")
        least = near.agg(F.min("component").alias("least"))
        joined = names.join(least, names["id"] == least["a"])
        closer = joined.select(
            "id", F.least("component", "least").alias("via"), F.col("component").alias("old")
        )
        of = names.select(F.col("id").alias("via"), F.col("component").alias("further"))
        before = names
        moved = stored(
            closer.join(of, "via").select(
                "id",
                F.least("via", "further").alias("component"),
                (F.least("via", "further") < F.col("old")).alias("changed"),
            ),
            "names",
        )
        names = moved.select("id", "component")
        names.scratch_folder = moved.scratch_folder
        discard(before)
        if not moved.filter("changed").limit(1).count():
            discard(edges)
            return names
