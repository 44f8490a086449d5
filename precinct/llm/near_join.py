"""Similarity join of word shingle sets in the metric space of the Jaccard distance.

The distance of two sets, one minus intersection over union, obeys the triangle inequality.
The join uses it with pivots, sets that all others around them are measured against:

1. Neighbourhoods. Sets within the wished distance share most parts, and of their rarest
   shared parts at least one. Texts that have nothing to do with each other are all at
   distance 1 from any pivot and from each other, where no pivot can tell them apart;
   sharing too few parts, they never meet.
2. Pivots. Each neighbourhood elects a pivot, the same one for those that overlap. Sets
   within the wished distance of their pivot are linked to it, so that among themselves
   nothing remains to be found. Others must be compared with sets in a window: their
   distances to the pivot differ by no more than the wished distance.
3. Voronoi regions. A region that is still large elects more pivots; each set goes home to
   the nearest, and to other regions whose radius, plus the wished distance, reaches it.
   This repeats, as long as it makes regions smaller.
4. What remains is divided into rings of that width around the pivot and into blocks of
   bounded size. For pairs of blocks in the same or in neighbouring rings, sketches tell which
   sets cannot be similar to any other. The whole sets of the rest are compared exactly. Two
   sets are looked at in the first of the regions that they share, and only if the links
   found so far leave them apart.

Links are the exact ones, or follow from exact ones: sets linked to the same pivot are one
component without a link of their own.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import free_name, give_back, importable, running, worker_table
from precinct.llm.components import components
from precinct.llm.shingles import Scheme, chunks, digests, shingle_sets
from precinct.plans.scratch import discard, stored

# Shingles in a region that is joined in one task, and in one that elects more pivots.
BLOCK = 1 << 15
LARGE = 1 << 24
# Shingles in a block, as a multiple: only sketches of them are copied to pairs of blocks.
SKETCHED = 32
# Words of 64 bits that pairs of sketches take at once.
AT_ONCE = 1 << 20
PIVOTS = 8
LEVELS = 4
# Rounds in which sets are dropped that share too few parts.
PRUNINGS = 2
# Bits of the bitmap of signatures: so many for each, and as a power of two at most (32 MB).
# A smaller share of them only means that more signatures are shuffled in vain.
BITS_EACH = 32
MOST_BITS = 28
# Buckets of values that are looked for; a list of them is broadcast.
BUCKETS = 1 << 20


def per_text(docs: DataFrame, words: int, name: str, schema: str, build) -> DataFrame:
    """Runs ``build(ids, hashes, sizes)`` over the shingle sets of ``name data``, in chunks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_table(None, None)
        slices = (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512))
        for rows in slices:
            texts = [x or b"" for x in rows.column(1).to_pylist()]
            for begin, part in chunks(texts):
                hashes, sizes = shingle_sets(part, words)
                yield build(rows.column(0).slice(begin, len(part)), hashes, sizes)
        rows = texts = part = hashes = sizes = None
        give_back()

    return importable(docs.select(name, "data")).mapInArrow(run, schema)


def described(data: DataFrame, words: int) -> DataFrame:
    """``doc_id n node``: the size of a document's set, and a number that equal sets share."""

    def build(ids, hashes, sizes):
        node = digests(hashes, sizes).view(np.int64)
        columns = [ids, pa.array(sizes.astype(np.int64)), pa.array(node)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "node"])

    return per_text(data, words, "doc_id", "doc_id bigint, n bigint, node bigint", build)


def signed(data: DataFrame, words: int, percent: int, wanted=None) -> DataFrame:
    """``signature node class need`` for all parts of all sets (see ``Scheme``).

    ``wanted`` is a broadcast bitmap: signatures that it does not have are left out.
    """
    scheme = Scheme(percent)
    by_bitmap = wanted is not None

    def build(ids, hashes, sizes):
        values, owners, classes, needs = scheme.signatures(hashes, sizes)
        if by_bitmap:
            bits = np.frombuffer(wanted.value, np.uint8)
            place = (values >> np.uint64(64 - (8 * len(bits)).bit_length() + 1)).astype(np.int64)
            keep = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            values, owners, classes, needs = (x[keep] for x in (values, owners, classes, needs))
        node = digests(hashes, sizes).view(np.int64)[owners]
        columns = [values.view(np.int64), node, classes.astype(np.int32), needs.astype(np.int32)]
        names = ["signature", "node", "class", "need"]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    schema = "signature bigint, node bigint, class int, need int"
    return per_text(data, words, "doc_id", schema, build)


def bitmap(signatures: DataFrame):
    """A broadcast bitmap with a bit for the first bits of each signature, sized by their number."""
    wished = max(1, BITS_EACH * signatures.count()).bit_length()
    power = min(MOST_BITS, max(16, wished))
    place = F.shiftrightunsigned("signature", 64 - power) + 1
    rows = (
        signatures.groupBy(F.bitmap_bucket_number(place).alias("number"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    whole = bytearray(1 << (power - 3))
    for row in rows:
        begin = (row["number"] - 1) * len(row["bits"])
        whole[begin : begin + len(row["bits"])] = row["bits"]
    return signatures.sparkSession.sparkContext.broadcast(bytes(whole))


def sets_of(data: DataFrame, words: int) -> DataFrame:
    """``id cells``: the shingle set of each document, sorted."""

    def build(ids, hashes, sizes):
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        cells = pa.ListArray.from_arrays(ends, pa.array(hashes.view(np.int64)))
        return pa.RecordBatch.from_arrays([ids, cells], ["id", "cells"])

    return per_text(data, words, "doc_id", "id bigint, cells array<bigint>", build)


def around(frame: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``column`` may be in the one column of ``wanted``, found without a shuffle.

    Values are compared by a bucket; the list of buckets is broadcast and has a fixed bound.
    """
    def bucket(name):
        return F.pmod(F.xxhash64(name), F.lit(BUCKETS)).cast("int").alias("_bucket")

    buckets = wanted.select(bucket(wanted.columns[0])).distinct()
    held = frame.withColumn("_bucket", bucket(column))
    return held.join(F.broadcast(buckets), "_bucket", "left_semi").drop("_bucket")


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` of ``id pivot`` with ``n`` (size of id), ``m`` (of pivot) and ``common``."""
    left = around(sets, "id", pairs.select("id")).select("id", F.col("cells").alias("_a"))
    right = around(sets, "id", pairs.select("pivot"))
    right = right.select(F.col("id").alias("pivot"), F.col("cells").alias("_b"))
    common = F.size(F.array_intersect("_a", "_b")).cast("long")
    counted = pairs.join(left, "id").join(right, "pivot").withColumns(
        {
            "n": F.size("_a").cast("long"),
            "m": F.size("_b").cast("long"),
            "common": common,
        }
    )
    return counted.drop("_a", "_b")


def union() -> Column:
    return F.col("n") + F.col("m") - F.col("common")


def linked(percent: int) -> Column:
    return 100 * F.col("common") >= percent * union()


def distance() -> Column:
    return 1 - F.col("common") / union()


def measured_around(inside: DataFrame, pivots: DataFrame, sets: DataFrame) -> DataFrame:
    """``inside`` measured against all ``pivots`` of its region, a row for each of them.

    Each member is moved to its region once, with all pivots and not once for each.
    """
    right = around(sets, "id", pivots.select("pivot")).select(F.col("id").alias("pivot"), "cells")
    held = pivots.join(right, "pivot").groupBy("region").agg(
        F.collect_list(F.struct("pivot", "cells")).alias("_pivots")
    )
    left = around(sets, "id", inside.select("id")).select("id", F.col("cells").alias("_a"))
    each = F.transform(
        "_pivots",
        lambda p: F.struct(
            p["pivot"].alias("pivot"),
            F.size(p["cells"]).cast("long").alias("m"),
            F.size(F.array_intersect("_a", p["cells"])).cast("long").alias("common"),
        ),
    )
    counted = inside.join(left, "id").join(held, "region")
    return counted.select(*inside.columns, F.size("_a").cast("long").alias("n"), F.inline(each))


class Found:
    """Links, kept as stored tables until they are joined."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def add(self, frame: DataFrame) -> None:
        self.tables.append(frame)

    def all(self) -> DataFrame:
        out = self.tables[0]
        for frame in self.tables[1:]:
            out = out.union(frame)
        return out


def open_members(regions: DataFrame, width: float) -> DataFrame:
    """Members of ``region origin id d n is_home`` that may have links that are not known yet.

    Those within ``width`` of the pivot are linked to it and one component. They are needed
    for the others only, and only from the least distance on at which there are others,
    less ``width``.
    """
    outside = F.col("d") > width
    need = regions.groupBy(F.col("region").alias("_region")).agg(
        F.min(F.when(outside, F.col("d"))).alias("_nearest")
    )
    need = need.filter(F.col("_nearest").isNotNull())
    window = outside | (F.col("d") >= F.col("_nearest") - width - 1e-9)
    kept = regions.join(need, F.col("region") == F.col("_region")).filter(window)
    return kept.drop("_region", "_nearest")


def divided(regions: DataFrame, sets: DataFrame, percent: int, level: int, large: int, found: Found):
    """Regions above ``large`` shingles as Voronoi regions of more pivots, where it helps."""
    width = 1 - percent / 100
    totals = regions.groupBy("region").agg(
        F.sum("n").alias("weight"), F.sum((F.col("d") > width).cast("long")).alias("open")
    )
    big = totals.filter((F.col("weight") > large) & (F.col("open") > 2 * PIVOTS))
    if not big.limit(1).count():
        return regions, False
    inside = stored(regions.join(big, "region"), "large")
    draw = F.pmod(F.xxhash64(F.lit(level), "region", "id"), F.lit(1 << 40)) / float(1 << 40)
    elected = inside.filter((F.col("d") > width) & (draw < PIVOTS / F.col("open")))
    pivots = stored(elected.select("region", F.col("id").alias("pivot")), "pivots")
    members = inside.select("region", "origin", "id", "is_home")
    far = stored(measured_around(members, pivots, sets).withColumn("d", distance()), "measured")
    found.add(
        far.filter(linked(percent) & (F.col("id") != F.col("pivot"))).select(
            F.col("id").alias("a"), F.col("pivot").alias("b")
        )
    )
    # Pivots are done: all of their region has been measured against them.
    rest = far.join(pivots.withColumnRenamed("pivot", "id"), ["region", "id"], "left_anti")
    nearest = F.min_by("pivot", F.struct("d", "pivot")).alias("home")
    homes = rest.groupBy("region", "id").agg(nearest)
    placed = rest.join(homes, ["region", "id"]).withColumn(
        "is_home", F.col("is_home") & (F.col("home") == F.col("pivot"))
    )
    reach = placed.filter("is_home").groupBy("region", "pivot").agg(F.max("d").alias("radius"))
    within = placed.join(reach, ["region", "pivot"]).filter(
        F.col("is_home") | (F.col("d") <= F.col("radius") + width + 1e-9)
    )
    cells = stored(within.select("region", "origin", "pivot", "id", "d", "n", "is_home"), "voronoi")
    # Where windows copy so much that there are not half as many pairs, blocks are better.
    copied = cells.groupBy("region", "pivot").agg(F.sum("n").alias("copied"))
    grown = copied.groupBy("region").agg(F.sum(F.pow("copied", F.lit(2))).alias("pairs"))
    fewer = 2 * F.col("pairs") < F.pow("weight", F.lit(2))
    better = grown.join(big, "region").filter(fewer).select("region")
    split = cells.join(better, "region").select(
        F.xxhash64("region", "pivot").alias("region"), "origin", "id", "d", "n", "is_home"
    )
    kept = regions.join(better, "region", "left_anti").select(*split.columns)
    return stored(kept.union(split), "regions"), True


def parity(cells: np.ndarray) -> bytes:
    """A sketch of a set: a bit for each hash value, with the parity of its shingles.

    Two sketches differ in no more bits than their sets in shingles. There are at least two
    bits a shingle, and as many as a power of two, so that a long sketch can be folded.
    """
    bits = max(64, 1 << int(2 * len(cells) - 1).bit_length())
    odd = np.bincount(cells & np.int64(bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def sketched(sets: DataFrame) -> DataFrame:
    """``id bits``: the sketch of each set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
            bits = [parity(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["id", "bits"])

    return importable(sets.select("id", "cells")).mapInArrow(run, "id bigint, bits binary")


def possible(part: pd.DataFrame, percent: int, width: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, of the two blocks of a group, that may be similar and are not linked yet.

    The sketches bound how much two sets differ. Rows have ``side id n d is_home bits comp``
    and ``others``, the regions besides this one in which a set is compared, too.
    """
    side, n, d, home, comp = (part[x].to_numpy() for x in ("side", "n", "d", "is_home", "comp"))
    one_block, ball = bool((side == 0).all()), d <= width
    lengths = [len(x) for x in part["others"]]
    names = np.concatenate([np.zeros(0, np.int64), *part["others"]]).astype(np.int64)
    _, number, times = np.unique(names, return_inverse=True, return_counts=True)
    # Two sets are compared in another region, if one comes before this one that has both.
    row, several = np.repeat(np.arange(len(part)), lengths), times[number] > 1
    place = (np.cumsum(times > 1) - 1)[number[several]]
    seen = np.zeros((len(part), (int((times > 1).sum()) + 63) // 64), np.uint64)
    bit = np.uint64(1) << (place & 63).astype(np.uint64)
    np.bitwise_or.at(seen, (row[several], place >> 6), bit)
    words = np.array([len(x) // 8 for x in part["bits"]])

    def table(rows: np.ndarray, wide: int) -> np.ndarray:
        held = np.frombuffer(b"".join(part["bits"].iloc[rows]), np.uint64).reshape(len(rows), -1)
        return held if held.shape[1] == wide else held[:, :wide] ^ held[:, wide:]

    for wide in np.unique(words).tolist():
        same, twice = np.flatnonzero(words == wide), np.flatnonzero(words == 2 * wide)
        for left, right in ((same, same), (same, twice), (twice, same)):
            left, right = left[side[left] <= 0], right[side[right] >= 0]
            if not len(left) or not len(right):
                continue
            ours, theirs = table(left, wide), table(right, wide)
            step = max(1, AT_ONCE // (len(right) * wide))
            for at in range(0, len(left), step):
                a, b = left[at : at + step, None], right[None, :]
                both = n[a] + n[b]
                ok = (comp[a] != comp[b]) & (home[a] | home[b]) & ~(ball[a] & ball[b])
                ok &= np.abs(d[a] - d[b]) <= width + 1e-9
                ok &= a < b if one_block else a != b
                differ = np.bitwise_count(ours[at : at + step, None] ^ theirs[None]).sum(2, dtype=np.int64)
                ok &= (both - differ) * (100 + percent) >= 2 * percent * both
                x, y = np.nonzero(ok)
                x, y = left[at + x], right[y]
                fresh = ~((seen[x] & seen[y]) != 0).any(1)
                yield x[fresh], y[fresh]


def involved(percent: int, width: float):
    """Rows of a group that may be similar to another one."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.reset_index(drop=True)
        needed = np.zeros(len(part), bool)
        for x, y in possible(part, percent, width):
            needed[x] = needed[y] = True
        return part[needed]

    return run


def leaf(percent: int, width: float):
    """Compares what may be similar in a group; gives the links of a spanning forest."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        cells = [np.sort(np.asarray(c, dtype=np.int64)) for c in part["cells"]]
        sizes = np.array([len(c) for c in cells])
        ids, parent = part["id"].to_numpy(), np.arange(len(part))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        _, first, same = np.unique(part["comp"].to_numpy(), return_index=True, return_inverse=True)
        parent[:] = first[same]
        out = []
        for xs, ys in possible(part, percent, width):
            cuts = np.flatnonzero(np.diff(xs)) + 1
            for x, own in zip(xs[np.concatenate([[0], cuts])] if len(xs) else [], np.split(ys, cuts)):
                for at in range(0, len(own), 32):
                    some = [y for y in own[at : at + 32].tolist() if root(y) != root(x)]
                    if not some:
                        continue
                    theirs = np.concatenate([cells[y] for y in some])
                    spot = np.minimum(np.searchsorted(cells[x], theirs), sizes[x] - 1)
                    begin = np.cumsum(sizes[some]) - sizes[some]
                    common = np.add.reduceat((cells[x][spot] == theirs).astype(np.int64), begin)
                    near = 100 * common >= percent * (sizes[some] + sizes[x] - common)
                    for y in np.array(some)[near].tolist():
                        one, two = root(int(x)), root(y)
                        if one != two:
                            parent[max(one, two)] = min(one, two)
                            out.append((ids[x], ids[y]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def small_region(percent: int, width: float):
    """Joins a region in one task: its pivot first, then what lies outside, in windows."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        cells = [np.asarray(c, dtype=np.int64) for c in part["cells"]]
        ids = part["id"].to_numpy()
        pivot = int(np.flatnonzero(ids == part["region"].to_numpy())[0])
        common = np.array([len(np.intersect1d(c, cells[pivot], True)) for c in cells])
        sizes = np.array([len(c) for c in cells])
        d = 1 - common / (sizes + sizes[pivot] - common)
        ball = (d <= width) & (ids != ids[pivot])
        links = pd.DataFrame({"a": ids[ball], "b": ids[pivot]}, dtype="int64")
        every = np.ones(len(ids), bool)
        return pd.concat([links, forest(ids, cells, d, every, every, every, percent, width)])

    return run


def forest(ids, cells, d, home, left, right, percent: int, width: float) -> pd.DataFrame:
    """Links of a spanning forest, between ``left`` and ``right`` sets of which one is home.

    Sets within ``width`` of the pivot are one component from the start.
    """
    sizes = np.fromiter(map(len, cells), np.int64, len(cells))
    _, token = np.unique(np.concatenate(cells), return_inverse=True)
    owner = np.repeat(np.arange(len(cells)), sizes)
    order = np.argsort(token, kind="stable")
    held = owner[order]
    ends = np.cumsum(np.bincount(token))
    begins = ends - np.diff(np.concatenate([[0], ends]))
    starts = np.cumsum(sizes) - sizes
    parent = np.arange(len(ids))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # What is linked to the pivot is one component already.
    ball = np.flatnonzero(d <= width)
    parent[ball] = ball[0] if len(ball) else 0
    out = []
    for x in np.flatnonzero(left).tolist():
        own = token[starts[x] : starts[x] + sizes[x]]
        b, n = begins[own], ends[own] - begins[own]
        spots = np.repeat(b - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        common = np.bincount(held[spots], minlength=len(ids))
        near = 100 * common >= percent * (sizes + sizes[x] - common)
        near &= right & (home | home[x]) & (np.abs(d - d[x]) <= width + 1e-9)
        if d[x] <= width:
            near &= d > width
        near[x] = False
        for y in np.flatnonzero(near).tolist():
            one, two = root(x), root(y)
            if one != two:
                parent[max(one, two)] = min(one, two)
                out.append((ids[x], ids[y]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def compared(
    regions: DataFrame, sets: DataFrame, around_pivots: DataFrame, names: DataFrame, percent: int, block: int
) -> DataFrame:
    """Links ``a b`` inside regions, by rings around the pivot and blocks of bounded size.

    ``around_pivots`` has the pairs ``id pivot`` of all regions, ``names`` the component of
    each id that has a link.
    """
    width = 1 - percent / 100
    bits = sketched(around(sets, "id", regions.select("id")))
    shared = around_pivots.groupBy("id").agg(F.collect_list("pivot").alias("pivots"))
    about = bits.join(shared, "id").join(names, "id", "left").select(
        "id", "bits", "pivots", F.coalesce("component", "id").alias("comp")
    )
    about = stored(about, "sketches")
    ring = F.floor(F.col("d") / (width + 1e-9)).cast("int")
    ringed = stored(regions.withColumn("ring", ring), "rings")
    count, keys = ringed.count(), ["region", "ring"]
    placed = running(ringed, keys, ["id"], {"first": F.col("n")}, count, least=64)
    placed = stored(placed.withColumn("block", F.floor(F.col("first") / (SKETCHED * block))), "blocks")
    known = placed.groupBy("region", "ring", "block").agg(F.count("*").alias("members"))
    known = stored(known.select("region", "ring", "block", "members"), "known-blocks")
    keys = ["region", "ring", "block"]
    left = known.select("region", *(F.col(n).alias(f"l_{n}") for n in (*keys[1:], "members")))
    right = known.select("region", *(F.col(n).alias(f"r_{n}") for n in (*keys[1:], "members")))
    ordered = (F.col("l_ring") == F.col("r_ring") - 1) | (
        (F.col("l_ring") == F.col("r_ring")) & (F.col("l_block") <= F.col("r_block"))
    )
    # Two blocks of the ball around the pivot, or one set alone, have nothing to compare.
    ball = (F.col("r_ring") == 0) & (F.col("l_ring") == 0)
    same = (F.col("l_ring") == F.col("r_ring")) & (F.col("l_block") == F.col("r_block"))
    pairs = left.join(right, "region").filter(ordered & ~ball & ~(same & (F.col("l_members") < 2)))
    numbered = pairs.withColumns(
        {
            "pair": F.xxhash64("region", "l_ring", "l_block", "r_ring", "r_block"),
            "same": same,
        }
    )
    side = [
        F.struct(F.col(f"{x}_ring").alias("ring"), F.col(f"{x}_block").alias("block"), y.alias("side"))
        for x, y in (("l", F.lit(0)), ("l", F.lit(-1)), ("r", F.lit(1)))
    ]
    ends = numbered.select(
        "region",
        "pair",
        F.inline(F.when(F.col("same"), F.array(side[0])).otherwise(F.array(*side[1:]))),
    )
    kept = ["pair", "side", "id", "n", "d", "is_home", "bits", "comp", "others"]
    others = F.filter("pivots", lambda p: p < F.col("origin")).alias("others")
    rows = placed.join(ends, keys).join(about, "id").select(*kept[:-1], others)
    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    needed = importable(rows).groupBy("pair").applyInPandas(involved(percent, width), kinds)
    whole = stored(needed, "involved").join(sets, "id").select(*kept, "cells")
    return importable(whole).groupBy("pair").applyInPandas(leaf(percent, width), "a bigint, b bigint")


def meetings(parts: DataFrame) -> DataFrame:
    """Signatures that more than one set has, with the number of sets and the first of them.

    Rows of copies are equal and count once.
    """
    seen = parts.groupBy("signature").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
    return seen.filter("pivot < last").select("signature")


def shared_parts(data: DataFrame, words: int, percent: int) -> DataFrame:
    """``signature node class need``, of sets that share as many parts as similar sets must.

    Most parts are of one text only. The bitmap of the others leaves them out of the second
    pass, in which the parts of copies become one. Sets that lack shared parts go, with them the parts they alone shared with one
    other set, and so on for a few rounds.
    """
    several = signed(data, words, percent).groupBy("signature").count().filter("count > 1")
    repeated = stored(several.select("signature"), "repeated")
    wanted = bitmap(repeated)
    discard(repeated)
    shared = stored(signed(data, words, percent, wanted).distinct(), "parts")
    wanted.destroy()
    for _ in range(PRUNINGS):
        before, parts = shared, shared.select("signature", "node", "class", "need")
        parts = parts.join(meetings(parts), "signature")
        enough = parts.groupBy("node", "class").agg(F.count("*").alias("shared"), F.max("need").alias("least"))
        enough = enough.filter("shared >= least").select("node", "class", "shared")
        shared = stored(parts.join(enough, ["node", "class"]), "parts")
        discard(before)
    return shared


def neighbourhoods(parts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``id pivot crowd``: sets that share a signature, with the first set of that signature.

    Of a set's shared parts the rarest count: so many that at least one of them is among
    those that it must have in common with a similar set. ``crowd`` tells whether others
    may share the signature, too.
    """
    counted = parts.groupBy("signature").agg(F.count("*").alias("sets"))
    rarest = Window.partitionBy("node", "class").orderBy("sets", "signature")
    kept = (
        parts.join(counted, "signature")
        .withColumn("place", F.row_number().over(rarest))
        .filter(F.col("place") <= F.col("shared") - F.col("need") + 1)
    )
    rows = stored(kept.select("signature", "node").distinct(), "kept-parts")
    first = rows.groupBy("signature").agg(
        F.min("node").alias("pivot"), (F.count("*") > 2).alias("crowd")
    )
    pairs = rows.join(first, "signature").filter("node <> pivot")
    pairs = pairs.groupBy("node", "pivot").agg(F.max("crowd").alias("crowd"))
    left = classes.select("node", "id", F.col("n").alias("size"))
    right = classes.select(
        F.col("node").alias("pivot"), F.col("id").alias("pivot_id"), F.col("n").alias("pivot_size")
    )
    named = pairs.join(left, "node").join(right, "pivot")
    small, large = F.least("size", "pivot_size"), F.greatest("size", "pivot_size")
    # Two sets of too unequal size cannot be linked, and have no others around them.
    near = named.filter(F.col("crowd") | (100 * small >= percent * large))
    return near.select("id", F.col("pivot_id").alias("pivot"), "crowd", "size", "pivot_size")


def keyed(docs: DataFrame, doc_id: str) -> tuple[DataFrame, bool]:
    """``docs`` with a ``key`` of their own for each row, and whether that is the id.

    Where ids are null or repeated, rows are stored with a number.
    """
    name, ids = free_name(docs, "key"), docs.select(docs[doc_id].cast("long").alias("id"))
    rows, given, different = ids.agg(
        F.count(F.lit(1)), F.count("id"), F.count_distinct("id")
    ).first()
    if rows == given == different:
        frame = docs.withColumn(name, docs[doc_id].cast("long"))
    else:
        frame = stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    frame.key = name
    return frame, rows == given == different


def near_components(
    docs: DataFrame,
    words: int = 4,
    percent: int = 85,
    doc_id: str = "doc_id",
    text: str = "text",
    large: int = LARGE,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id n_shingles component_id copies_of`` for every document.

    Words are runs without white space, with A-Z lower-cased; a set holds the distinct
    shingles of ``words`` words, or the whole sequence of a shorter text. Documents link
    when their intersection is ``percent`` of their union or more. ``component_id`` is the
    smallest id reachable by links; ``copies_of`` the smallest id with the same set.

    Null texts and texts without words have empty sets and are linked with nothing. Ids are
    integers. Rows with a null or repeated id are documents of their own: each gets the
    component of its own text, and the id of the component is the smallest one of its rows,
    null where none has one. An empty table gives an empty result. Other columns are not used.
    """
    frame, by_id = keyed(docs, doc_id)
    data = frame.select(F.col(frame.key).alias("doc_id"), frame[text].cast("binary").alias("data"))
    found = grouped(data, words, percent, large, block)
    if by_id:
        return found
    named = frame.select(F.col(frame.key).alias("key"), frame[doc_id].cast("long").alias("name"))
    rows = stored(found.join(named, F.col("doc_id") == F.col("key")), "named")

    def least(group: str, alias: str) -> DataFrame:
        return rows.groupBy(F.col(group).alias(f"of_{alias}")).agg(F.min("name").alias(alias))

    labels, firsts = least("component_id", "label"), least("copies_of", "first")
    joined = rows.join(labels, F.col("component_id") == F.col("of_label")).join(
        firsts, F.col("copies_of") == F.col("of_first")
    )
    return joined.select(
        F.col("name").alias("doc_id"),
        "n_shingles",
        F.col("label").alias("component_id"),
        F.col("first").alias("copies_of"),
    )


def without_near_copies(
    docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``docs`` for each component of ``near_components``, with all its columns.

    Where all ids differ it is the row with the smallest; repeated rows, and rows without an
    id, are documents like others, of which one stays.
    """
    frame, _ = keyed(docs, doc_id)
    data = frame.select(F.col(frame.key).alias("doc_id"), frame[text].cast("binary").alias("data"))
    found = grouped(data, words, percent)
    firsts = found.filter("doc_id = component_id").select(F.col("doc_id").alias(frame.key))
    return frame.join(firsts, frame.key, "left_semi").select(docs.columns)


def grouped(
    data: DataFrame, words: int, percent: int, large: int = LARGE, block: int = BLOCK
) -> DataFrame:
    """``near_components`` of rows ``doc_id data`` whose ids differ."""
    whole = stored(described(data, words), "described")
    classes = whole.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("id"), F.count("*").alias("members"), F.first("n").alias("n")
    )
    classes = stored(classes, "classes")
    parts = shared_parts(data, words, percent)
    regions = stored(neighbourhoods(parts, classes, percent), "regions")
    discard(parts)
    involved = regions.select("id").union(regions.select("pivot"))
    sets = stored(sets_of(around(data, "doc_id", involved), words), "sets")
    found, width = Found(), 1 - percent / 100
    # A region that is no more than a block is joined in one task, all others step by step.
    weights = regions.filter("crowd").groupBy(F.col("pivot").alias("region")).agg(
        (F.sum("size") + F.first("pivot_size")).alias("weight")
    )
    fits = stored(weights.filter(F.col("weight") <= block).select("region"), "small-regions")
    inside = regions.filter("crowd").select(F.col("pivot").alias("region"), "id")
    inside = inside.join(fits, "region").union(fits.select("region", F.col("region").alias("id")))
    grouped = importable(inside.join(sets, "id")).groupBy("region")
    small = grouped.applyInPandas(small_region(percent, width), "a bigint, b bigint")
    found.add(stored(small, "links"))
    done = fits.select(F.col("region").alias("pivot"), F.lit(True).alias("crowd"))
    steps = regions.join(done, ["pivot", "crowd"], "left_anti")
    far = stored(measured(steps, sets), "measured")
    found.add(far.filter(linked(percent)).select(F.col("id").alias("a"), F.col("pivot").alias("b")))
    crowded = far.filter("crowd").select(
        F.col("pivot").alias("region"),
        F.col("pivot").alias("origin"),
        "id",
        distance().alias("d"),
        "n",
        F.lit(True).alias("is_home"),
    )
    left = stored(open_members(crowded, width), "regions")
    for level in range(LEVELS):
        left, more = divided(left, sets, percent, level, large, found)
        if not more:
            break
    names = components(found.all())
    around_pivots = regions.filter("crowd").select("id", "pivot")
    last = stored(compared(left, sets, around_pivots, names, percent, block), "links")
    names = components(names.select(F.col("id").alias("a"), F.col("component").alias("b")).union(last))
    labels = classes.join(names, "id", "left").withColumn("component", F.coalesce("component", "id"))
    many = labels.filter("members > 1 OR component <> id").select(
        F.col("node").alias("of"), F.col("id").alias("copies_of"), "component"
    )
    joined = whole.join(many, (F.col("node") == F.col("of")) & (whole["n"] > 0), "left")
    return joined.select(
        "doc_id",
        whole["n"].alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("copies_of", "doc_id").alias("copies_of"),
    )
