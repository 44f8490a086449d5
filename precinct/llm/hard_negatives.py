"""Hard negatives by inner product, with bounds along a spanning tree of the anchors.

For anchors p and c and a candidate x, the scores p.x and c.x differ by no more than the
distance of p and c times the length of x. Anchors of a block are joined by a spanning tree
of least total distance; from the scores, or bounds, at a parent follow bounds at its
children. At each anchor only candidates whose bounds overlap the wanted window are scored
anew, in whole numbers; the others hand their bounds down.

Positives come first: the window begins at the k-th highest lower bound. They tell the window
of each negative, which likewise rises to the k-th highest lower bound inside it. Anchors
travel in blocks, candidates lie in groups of bounded size, and a block meets a group only if
the group has a label (for positives) or the lengths (for negatives) that can matter.
"""

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import importable, running
from precinct.llm.top_k import products
from precinct.plans.scratch import stored

# Candidates of a group and anchors of a block.
GROUP = 4_096
BLOCK = 256
# Parts in which the rows of an anchor are merged first.
SALTS = 16

ARRAYS = {"rows": np.int64, "ids": np.int64, "labels": np.int64, "cells": np.int64}
TREE = {"order": np.int64, "parent": np.int64, "edge": np.float64}
PACKED = (
    "rows binary, ids binary, labels binary, cells binary, order binary, parent binary, "
    "edge binary, members array<bigint>, label_set array<bigint>, longest double"
)
FOUND = "row bigint, place int, other bigint, vec_id bigint, score bigint"


class Pack(NamedTuple):
    """Vectors with row numbers, ids and labels; as anchors, with their tree."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    cells: np.ndarray
    order: np.ndarray
    parent: np.ndarray
    edge: np.ndarray

    def lengths(self) -> np.ndarray:
        return np.linalg.norm(self.cells.astype(np.float64), axis=1)


def spanning_tree(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors with parents first, the parent of each (-1: root) and the distance to it."""
    points = cells.astype(np.float64)
    n = len(points)
    near = np.full(n, np.inf)
    link = np.full(n, -1)
    edge = np.zeros(n)
    out = np.zeros(n, bool)
    order = []
    at = 0
    for _ in range(n):
        order.append(at)
        out[at] = True
        apart = np.linalg.norm(points - points[at], axis=1)
        closer = ~out & (apart < near)
        near[closer], link[closer] = apart[closer], at
        left = np.flatnonzero(~out)
        if len(left):
            at = int(left[np.argmin(near[left])])
            edge[at] = near[at]
    return np.array(order), link, edge


def numbered(
    vectors: DataFrame, anchor: Column, vec_id: str, vector: str, label: str, scale: int
) -> DataFrame:
    """``row vec_id label cells is_anchor`` of the rows that take part."""
    raw = vectors[vector].cast("array<double>")
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    part = vectors[vec_id].isNotNull() & vectors[label].isNotNull()
    return vectors.filter(part & vectors[vector].isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        vectors[vec_id].cast("bigint").alias("vec_id"),
        vectors[label].cast("bigint").alias("label"),
        F.transform(raw, lambda x: F.floor(x * F.lit(float(scale)))).alias("cells"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    )


def packer(with_tree: bool):
    """The rows of a pack as one value."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        cells = np.zeros((len(part), max(map(len, part["cells"]))), np.int64)
        for row, own in zip(cells, part["cells"]):
            row[: len(own)] = own
        labels = part["label"].to_numpy(np.int64)
        tree = spanning_tree(cells) if with_tree else (np.empty(0),) * 3
        value = {
            "rows": part["row"].to_numpy(np.int64).tobytes(),
            "ids": part["vec_id"].to_numpy(np.int64).tobytes(),
            "labels": labels.tobytes(),
            "cells": cells.tobytes(),
            **{name: x.astype(kind).tobytes() for (name, kind), x in zip(TREE.items(), tree)},
            "members": part["row"].to_numpy(np.int64),
            "label_set": np.unique(labels),
            "longest": float(np.linalg.norm(cells.astype(np.float64), axis=1).max()),
        }
        return pd.DataFrame([value])

    return pack


def packs(rows: DataFrame, most: int, name: str, with_tree: bool) -> DataFrame:
    """Rows in packs of at most ``most``, stored, with a number ``name``.

    Rows of a label are counted off into packs, however many there are and however they are
    dealt to tasks; labels with fewer rows share packs.
    """
    counts = stored(rows.groupBy("label").agg(F.count("*").alias("many")), "labels")
    total, small = counts.agg(F.sum("many"), F.sum(F.when(F.col("many") < most, F.col("many")))).first()
    shared = F.pmod(F.xxhash64("label"), F.lit(max(1, -(-(small or 0) // most))))
    home = F.when(F.col("many") < most, F.struct(F.lit(True).alias("shared"), shared.alias("of")))
    home = home.otherwise(F.struct(F.lit(False).alias("shared"), F.col("label").alias("of")))
    homed = rows.join(counts, "label").withColumn("home", home)
    columns = ["row", "vec_id", "label", "cells", "home"]
    counted = running(homed.select(columns), ["home"], ["row"], {"place": F.lit(1)}, total or 0)
    packed = importable(counted.withColumn("pack", F.floor(F.col("place") / most)))
    packed = packed.groupBy("home", "pack").applyInPandas(packer(with_tree), PACKED)
    return stored(packed.withColumn(name, F.monotonically_increasing_id()), name)


def unpack(value: dict, prefix: str) -> Pack:
    arrays = {n: np.frombuffer(value[prefix + n], t) for n, t in (ARRAYS | TREE).items()}
    arrays["cells"] = arrays["cells"].reshape(len(arrays["rows"]), -1)
    return Pack(**arrays)


def walk(anchors: Pack, group: Pack, choose: Callable, take: Callable) -> int:
    """Visits the tree; gives the number of scores computed.

    ``choose(at, low, high)`` tells which candidates may be wanted at an anchor, by bounds of
    all; ``take(at, spots, scores)`` gets the scores of those.
    """
    lengths = group.lengths()
    size = anchors.lengths()
    waiting = np.bincount(anchors.parent[anchors.parent >= 0], minlength=len(size))
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    scored = 0
    for at in anchors.order.tolist():
        parent = int(anchors.parent[at])
        if parent < 0:
            low, high = np.full(len(lengths), -np.inf), np.full(len(lengths), np.inf)
            spots = np.arange(len(lengths))
        else:
            # The last two terms are more than what rounding can take away.
            apart = anchors.edge[at] * (1 + 1e-9) + 1e-12 * (size[at] + size[parent])
            reach = apart * lengths + 1
            low, high = held[parent][0] - reach, held[parent][1] + reach
            waiting[parent] -= 1
            if not waiting[parent]:
                del held[parent]
            spots = np.flatnonzero(choose(at, low, high))
        scores = products(anchors.cells[at : at + 1], group.cells[spots])[0]
        low[spots] = high[spots] = scores
        scored += len(spots)
        if waiting[at]:
            held[at] = (low, high)
        take(at, spots, scores)
    return scored


def kth(values: np.ndarray, k: int) -> float:
    """The k-th highest value, or minus infinity if there are fewer."""
    return float(np.partition(values, -k)[-k]) if len(values) >= k else -np.inf


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, in order, ties by the smaller id."""
    some = np.arange(len(scores))
    if len(scores) > 4 * k:
        some = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return some[np.lexsort((ids[some], -scores[some]))][:k]


class Rows:
    """Result rows of a block and a group."""

    def __init__(self) -> None:
        self.columns: list[list[np.ndarray]] = [[] for _ in range(5)]

    def add(self, row: int, place: int, others: np.ndarray, ids: np.ndarray, scores) -> None:
        n = len(others)
        values = (np.full(n, row), np.full(n, place), others, ids, scores)
        for column, value in zip(self.columns, values):
            column.append(value)

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [
            pa.array(np.concatenate([np.empty(0, np.int64), *c]).astype(np.int64)).cast(kind)
            for c, kind in zip(self.columns, kinds)
        ]
        return pa.RecordBatch.from_arrays(arrays, ["row", "place", "other", "vec_id", "score"])


def positives_of(anchors: Pack, group: Pack, k: int) -> pa.RecordBatch:
    """The ``k`` best of a group with the label of each anchor, without the anchor itself."""
    out = Rows()

    def others(at: int) -> np.ndarray:
        return (group.labels == anchors.labels[at]) & (group.rows != anchors.rows[at])

    def choose(at: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        own = others(at)
        return own & (high >= kth(low[own], k))

    def take(at: int, spots: np.ndarray, scores: np.ndarray) -> None:
        own = others(at)[spots]
        spots, scores = spots[own], scores[own]
        best = first(scores, group.ids[spots], k)
        spots = spots[best]
        out.add(anchors.rows[at], 0, group.rows[spots], group.ids[spots], scores[best])

    walk(anchors, group, choose, take)
    return out.batch()


def negatives_of(anchors: Pack, group: Pack, windows: dict, k: int) -> pa.RecordBatch:
    """For each anchor and window the ``k`` best of a group with another label.

    ``windows`` has a list of ``(place, least, most)`` for the row number of an anchor.
    """
    out = Rows()

    def choose(at: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        wanted = np.zeros(len(low), bool)
        other = group.labels != anchors.labels[at]
        for _, least, most in windows.get(int(anchors.rows[at]), ()):
            surely = other & (low >= least) & (high <= most)
            wanted |= other & (high >= max(least, kth(low[surely], k))) & (low <= most)
        return wanted

    def take(at: int, spots: np.ndarray, scores: np.ndarray) -> None:
        other = group.labels[spots] != anchors.labels[at]
        for place, least, most in windows.get(int(anchors.rows[at]), ()):
            inside = np.flatnonzero(other & (scores >= least) & (scores <= most))
            own = spots[inside]
            best = first(scores[inside], group.ids[own], k)
            own = own[best]
            out.add(anchors.rows[at], place, group.rows[own], group.ids[own], scores[inside][best])

    walk(anchors, group, choose, take)
    return out.batch()


def joined(pairs: DataFrame, blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs ``block group`` with the packs of both sides, and what else ``pairs`` has."""

    def named(frame: DataFrame, key: str) -> DataFrame:
        columns = [F.col(n).alias(f"{key}_{n}") for n in (*ARRAYS, *TREE)]
        return frame.select(key, *columns)

    return pairs.join(named(blocks, "block"), "block").join(named(groups, "group"), "group")


def runner(search: Callable, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                value = {n: c[at].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                anchors, group = unpack(value, "block_"), unpack(value, "group_")
                windows: dict[int, list] = {}
                for w in value.get("windows") or ():
                    windows.setdefault(w["row"], []).append((w["place"], w["least"], w["most"]))
                yield search(anchors, group, windows, k)

    return run


def ranked(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of each key with their ``rank``, merged in two steps."""
    order = [F.desc("score"), "vec_id", "other"]
    out = rows.withColumn("_salt", F.pmod(F.xxhash64("other"), F.lit(SALTS)))
    for part in ([*keys, "_salt"], keys):
        place = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        out = out.withColumn("rank", place).filter(F.col("rank") <= k)
    return out.drop("_salt")


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id positive_id rank negative_id positive_score negative_score``.

    Components become ``floor(scale * x)``; a score is an inner product of those. Anchors are
    the rows for which ``anchor`` is true. An anchor's positives are the ``positives`` best
    other rows of its label; for each, the ``negatives`` best rows of another label with a
    score from ``low`` to ``high`` percent of the positive's. Higher scores come first, ties go
    by the smaller ``vec_id``; ranks begin with 1. Where there are fewer, there are fewer rows.

    Rows with a null id, label or vector, or a null or non-finite component, take no part.
    Labels are whole numbers. Repeated rows and rows that share an id are rows of their own:
    a copy of an anchor is another anchor and may be its positive. Vectors of unequal width
    count as padded with zeros. Empty tables give an empty result. Other columns are not used.
    """
    rows = stored(numbered(vectors, anchor, vec_id, vector, label, scale), "vectors")
    blocks = packs(rows.filter("is_anchor"), BLOCK, "block", True)
    groups = packs(rows, GROUP, "group", False)
    block_labels = blocks.select("block", F.explode("label_set").alias("label"))
    group_labels = groups.select("group", F.explode("label_set").alias("label"))
    alike = block_labels.join(group_labels, "label").select("block", "group").distinct()

    def search_positives(anchors, group, windows, k):
        return positives_of(anchors, group, k)

    near = importable(joined(alike, blocks, groups)).mapInArrow(
        runner(search_positives, positives), FOUND
    )
    best = stored(ranked(near, ["row"], positives), "positives")
    # Whole numbers n with low * p <= 100 * n <= high * p.
    share = "CAST(score AS DECIMAL(20, 0)) * ({}) / 100"
    least = F.expr(f"CAST(ceil({share.format(low)}) AS BIGINT)")
    most = F.expr(f"CAST(floor({share.format(high)}) AS BIGINT)")
    bounds = best.select("row", F.col("rank").alias("place"), least.alias("least"), most.alias("most"))
    bounds = bounds.filter("least <= most")
    anchors = rows.filter("is_anchor")
    square = F.aggregate("cells", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    sized = anchors.select("row", F.sqrt(square).alias("size"))
    members = blocks.select("block", F.explode("members").alias("row"))
    wanted = members.join(bounds, "row").join(sized, "row")
    # A group whose longest vector is too short for the least window of a block is not sent.
    needs = wanted.groupBy("block").agg(
        F.collect_list(F.struct("row", "place", "least", "most")).alias("windows"),
        F.min(
            F.when(F.col("least") <= 0, F.lit(0.0)).otherwise(F.col("least") / F.col("size"))
        ).alias("shortest"),
    )
    needs = stored(needs.join(blocks.select("block", "label_set"), "block"), "windows")
    many = max(1, groups.count())
    bucket = F.pmod(F.xxhash64("group"), F.lit(many)).alias("bucket")
    sides = groups.select("group", "longest", F.col("label_set").alias("labels"), bucket)
    spread = needs.select(
        "block", "shortest", "label_set", F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("bucket")
    ).withColumn("bucket", F.col("bucket").cast("bigint"))
    one_label = (F.size("label_set") == 1) & (F.col("label_set") == F.col("labels"))
    meet = spread.join(sides, "bucket").filter(
        (F.col("longest") * (1 + 1e-9) >= F.col("shortest")) & ~one_label
    )
    meet = meet.select("block", "group").join(needs.select("block", "windows"), "block")
    far = importable(joined(meet, blocks, groups)).mapInArrow(runner(negatives_of, negatives), FOUND)
    last = ranked(far, ["row", "place"], negatives)
    known = best.select(
        "row",
        F.col("rank").alias("place"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    named = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return (
        last.join(known, ["row", "place"])
        .join(named, "row")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
