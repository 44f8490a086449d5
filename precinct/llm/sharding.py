"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Equal texts form a group, which stays in one shard. Groups of a noticeable size are items of
their own; the many small ones are first bundled by a hash of their text, so that the number
of items is bounded by a parameter and not by the data. Items sorted by size enter the bin
with the tightest remaining capacity that still holds them, found in a balanced tree. A group
above an equal share has a bin of its own; the capacity of the others is the smallest for
which the bins that are left are enough.

Null and empty texts are groups too (of size 1 a row), repeated rows are rows of a group, and
an empty table gives an empty result.
"""

from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import running
from precinct.plans.scratch import stored

# Items per shard: bundles are this part of a shard, so sizes come out near equal.
ITEMS_PER_SHARD = 512


class CapacityTree:
    """Bins by remaining capacity, in a balanced tree (a B-tree of two levels).

    Leaves are sorted runs of at most ``2 * WIDTH`` bins that divide when full; an index of
    their largest entries leads to a leaf. Taking, adding and finding cost O(WIDTH + bins /
    WIDTH) moves of pointers and O(log bins) comparisons.
    """

    WIDTH = 256

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = []
        self.largest: list[tuple[int, int]] = []

    def add(self, room: int, name: int) -> None:
        entry = (room, name)
        if not self.leaves:
            self.leaves, self.largest = [[entry]], [entry]
            return
        at = min(bisect_left(self.largest, entry), len(self.leaves) - 1)
        leaf = self.leaves[at]
        leaf.insert(bisect_left(leaf, entry), entry)
        if len(leaf) > 2 * self.WIDTH:
            half = len(leaf) // 2
            self.leaves[at : at + 1] = [leaf[:half], leaf[half:]]
            self.largest[at : at + 1] = [leaf[half - 1], leaf[-1]]
        else:
            self.largest[at] = leaf[-1]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes the bin with the least room of at least ``size``; ties to the first bin."""
        at = bisect_left(self.largest, (size, -1))
        if at == len(self.leaves):
            return None
        leaf = self.leaves[at]
        entry = leaf.pop(bisect_left(leaf, (size, -1)))
        if leaf:
            self.largest[at] = leaf[-1]
        else:
            del self.leaves[at], self.largest[at]
        return entry


def pack(sizes: list[int], capacity: int, most_bins: int | None = None) -> list[int] | None:
    """The bin of each item, best fit in the given order; None if bins run out.

    Sizes have to be decreasing. An item above ``capacity`` gets a bin of its own.
    """
    tree, bins, places = CapacityTree(), 0, []
    for size in sizes:
        found = tree.take_tightest(size)
        if found is None:
            if most_bins is not None and bins == most_bins:
                return None
            found, bins = (max(capacity, size), bins), bins + 1
        room, name = found
        places.append(name)
        tree.add(room - size, name)
    return places


def pack_into(sizes: list[int], bins: int) -> list[int]:
    """The bin of each item, none above its share more than packing needs.

    Sizes have to be decreasing. An item above an equal share of what is left gets a bin of
    its own, which makes the share of the others smaller; these are packed into the bins that
    are left, at the smallest capacity found for which they suffice.
    """
    alone, left = 0, sum(sizes)
    while alone < len(sizes) and sizes[alone] * (bins - alone) > left:
        left -= sizes[alone]
        alone += 1
    rest = pack_evenly(sizes[alone:], bins - alone)
    return [*range(alone), *(alone + place for place in rest)]


def pack_evenly(sizes: list[int], bins: int) -> list[int]:
    """The bin of each item for the smallest capacity at which ``bins`` bins suffice."""
    if not sizes:
        return []
    low = max(max(sizes), -(-sum(sizes) // bins))
    high = low + max(sizes)  # bins of this size suffice: while one is missing, each has no room
    best = pack(sizes, high, bins)
    while best is None:
        high *= 2
        best = pack(sizes, high, bins)
    while low < high:
        middle = (low + high) // 2
        tried = pack(sizes, middle, bins)
        if tried is None:
            low = middle + 1
        else:
            best, high = tried, middle
    return best


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none), plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def group_key(text: Column) -> Column:
    """Equal for equal texts only; null texts are a group."""
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b"null"))


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    capacity: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    items_per_shard: int = ITEMS_PER_SHARD,
) -> DataFrame:
    """``doc_id size text_crc32 shard slot`` for every document.

    Sizes of shards are near equal: a group above a shard's share has a shard of its own, the
    others differ by about a bundle. With a ``capacity`` the number of shards is what
    packing needs at that capacity instead, and a larger group has a shard of its own. At
    most ``2 * shards * items_per_shard`` items come to the driver, however many documents
    there are. Slots count from 0 in each shard.
    """
    body = docs[text]
    rows = stored(
        docs.select(
            docs[doc_id].alias("doc_id"),
            text_size(body).alias("size"),
            F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).alias("text_crc32"),
            group_key(body).alias("key"),
        ),
        "shard-rows",
    )
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if capacity is not None:
        shards = max(1, -(-total // capacity))
    limit = max(1, total // (shards * items_per_shard))
    bundles = shards * items_per_shard
    bundle = F.pmod(F.xxhash64("key"), F.lit(bundles))
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"))
    # Groups above the limit are at most total / limit; smaller ones are summed by bundle.
    is_item = F.col("size") > limit
    items = (
        groups.select(
            F.when(is_item, F.col("key")).alias("key"),
            F.when(~is_item, bundle).alias("bundle"),
            "size",
        )
        .groupBy("key", "bundle")
        .agg(F.sum("size").alias("size"))
        .collect()
    )
    items.sort(key=lambda i: (-i["size"], bytes(i["key"] or b""), i["bundle"] or 0))
    sizes = [i["size"] for i in items]
    places = pack_into(sizes, shards) if capacity is None else pack(sizes, capacity)
    spark = docs.sparkSession
    large = [(bytes(i["key"]), p) for i, p in zip(items, places) if i["key"] is not None]
    small = [(i["bundle"], p) for i, p in zip(items, places) if i["key"] is None]
    by_key = spark.createDataFrame(large, "key binary, by_key int")
    by_bundle = spark.createDataFrame(small, "bundle bigint, by_bundle int")
    placed = (
        rows.withColumn("bundle", bundle)
        .join(F.broadcast(by_key), "key", "left")
        .join(F.broadcast(by_bundle), "bundle", "left")
        .withColumn("shard", F.coalesce("by_key", "by_bundle"))
        .select("doc_id", "size", "text_crc32", "shard")
    )
    return running(placed, ["shard"], ["doc_id", "text_crc32"], {"slot": F.lit(1)}, count)
