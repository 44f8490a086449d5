"""Exact top-k search by inner product, with vectors in buckets of like length.

Vectors are sorted by length into buckets. For a query with a known lower bound of its k-th
score, the bound over the lengths of query and bucket is the cosine that a vector of the
bucket must reach. Above 1, the bucket is skipped. Where it is high, vectors are pruned by
coordinates: the query's largest coordinates leave a feasible interval for the same
coordinates of a matching direction. Else they are pruned by length alone. What is left is
verified by products of whole numbers.

Bounds come first from the longest vectors, then from the bucket groups themselves. Queries
travel in blocks and meet each bucket group once; nothing grows into one task.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import importable
from precinct.plans.scratch import stored

# Vectors of a bucket, buckets of a group, and queries of a block.
BUCKET = 1_024
GROUP = 8
BLOCK = 512
# From this cosine on, coordinates prune more than they cost; so many of them are looked at.
COORDINATES_FROM = 0.75
COORDINATES = 4

PACKED = "ids binary, cells binary, bounds binary, width int, edge double"
FOUND = "query_id bigint, vec_id bigint, score bigint"


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """``vec_id cells length``: floor(scale * x) of each component, and the vector's length.

    Null vectors, and those with null or non-finite components, take no part.
    """
    raw = vectors[vector].cast("array<double>")
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    cells = F.transform(raw, lambda x: F.floor(x * F.lit(float(scale))))
    square = F.aggregate("cells", F.lit(0.0), lambda total, x: total + x * x.cast("double"))
    return (
        vectors.select(vectors[vec_id].alias("vec_id"), raw.alias("raw"), cells.alias("cells"))
        .filter(vectors[vec_id].isNotNull() & vectors[vector].isNotNull() & finite)
        .select("vec_id", "cells", F.sqrt(square).alias("length"))
    )


def pack(part: pd.DataFrame, bound: np.ndarray) -> dict:
    """Rows as one value: ids, a matrix padded with zeros to the widest, and a bound each.

    ``edge`` is the greatest length of vectors, and of queries the least length that a vector
    needs to reach the bound of any of them.
    """
    width = max((len(c) for c in part["cells"]), default=0)
    cells = np.zeros((len(part), width), np.int64)
    for row, own in zip(cells, part["cells"]):
        row[: len(own)] = own
    ids = part["vec_id"].to_numpy(np.int64)
    if "bound" in part.columns:
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(bound > 0, bound / part["length"].to_numpy(np.float64), 0.0)
        edge = float(needed.min(initial=np.inf))
    else:
        edge = float(bound.max(initial=0.0))
    values = {"ids": ids, "cells": cells, "bounds": bound}
    return {n: x.tobytes() for n, x in values.items()} | {"width": width, "edge": edge}


def packer(rows: int, bound: str):
    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0
        for part in parts:
            while len(part):
                held.append(part.iloc[: rows - count])
                count += len(held[-1])
                part = part.iloc[len(held[-1]) :]
                if count == rows:
                    whole = pd.concat(held)
                    yield pd.DataFrame([pack(whole, whole[bound].to_numpy(np.float64))])
                    held, count = [], 0
        if count:
            whole = pd.concat(held)
            yield pd.DataFrame([pack(whole, whole[bound].to_numpy(np.float64))])

    return run


def unpacked(ids: bytes, cells: bytes, bounds: bytes, width: int):
    names = np.frombuffer(ids, np.int64)
    matrix = np.frombuffer(cells, np.int64).reshape(len(names), width)
    return names, matrix, np.frombuffer(bounds, np.float64)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products, exact: in the smallest type that holds every partial sum."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    most = np.abs(left).max(initial=0) * float(np.abs(right).max(initial=0)) * max(1, width)
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return (left.astype(kind) @ right.astype(kind).T).astype(np.int64)


def feasible(unit: np.ndarray, query: np.ndarray, cosine: float) -> np.ndarray:
    """Which directions can have at least ``cosine`` with a query, by a few coordinates."""
    keep = np.ones(len(unit), bool)
    for at in np.argsort(-np.abs(query))[:COORDINATES]:
        q = query[at]
        middle = q * cosine
        reach = np.sqrt(max(0.0, (1 - q * q) * (1 - cosine * cosine))) + 1e-9
        # Beyond the middle, a coordinate is bounded by the cosine only where it is short.
        low = middle - reach if q > -cosine else -1.0
        high = middle + reach if q < cosine else 1.0
        keep &= (unit[:, at] >= low) & (unit[:, at] <= high)
    return keep


class Best:
    """The k best of each query of a block so far."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, k: int) -> None:
        self.ids, self.k = ids, k
        self.bounds = bounds.copy()  # the k-th score is no lower; -inf where nothing is known
        self.rows = np.empty(0, np.int64)
        self.names = np.empty(0, np.int64)
        self.scores = np.empty(0, np.int64)

    def offer(self, rows: np.ndarray, names: np.ndarray, scores: np.ndarray) -> None:
        take = (scores >= self.bounds[rows]) & (names != self.ids[rows])
        rows = np.concatenate([self.rows, rows[take]])
        names = np.concatenate([self.names, names[take]])
        scores = np.concatenate([self.scores, scores[take]])
        order = np.lexsort((names, -scores, rows))
        rows, names, scores = rows[order], names[order], scores[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < self.k
        self.rows, self.names, self.scores = rows[keep], names[keep], scores[keep]
        last = place == self.k - 1
        self.bounds[rows[last]] = np.maximum(self.bounds[rows[last]], scores[last])


def search(queries, groups, k: int) -> Best:
    """One block of queries against one group of vectors, bucket by bucket."""
    ids, asked, bounds = queries
    names, cells, lengths = groups
    best = Best(ids, bounds, k)
    sizes = np.linalg.norm(asked.astype(np.float64), axis=1)
    for begin in range(0, len(names), BUCKET):
        end = min(begin + BUCKET, len(names))
        own, length, matrix = names[begin:end], lengths[begin:end], cells[begin:end]
        longest = length.max(initial=0.0)
        reach = sizes * longest
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(reach > 0, best.bounds / reach, np.where(best.bounds > 0, 2.0, -2.0))
        alive = cosine <= 1 + 1e-9
        fine = np.flatnonzero(alive & (cosine >= COORDINATES_FROM))
        plain = np.flatnonzero(alive & (cosine < COORDINATES_FROM))
        if len(fine):
            width = min(asked.shape[1], matrix.shape[1])
            unit = matrix[:, :width] / np.maximum(length, 1e-300)[:, None]
            for row in fine:
                # Vectors of the bucket are shorter than its longest, so need no less a cosine.
                direction = asked[row, :width] / sizes[row]
                at = np.flatnonzero(feasible(unit, direction, min(1.0, float(cosine[row]))))
                if len(at):
                    score = products(asked[row : row + 1], matrix[at])[0]
                    best.offer(np.full(len(at), row), own[at], score)
        if len(plain):
            # By length: buckets are sorted, so what can reach the lowest bound comes first.
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.where(sizes[plain] > 0, best.bounds[plain] / sizes[plain], -np.inf).min()
            at = np.flatnonzero(length >= least * (1 - 1e-9)) if least > 0 else np.arange(len(own))
            score = products(asked[plain], matrix[at])
            same = own[at][None, :] == ids[plain][:, None]
            floor = np.partition(np.where(same, np.iinfo(np.int64).min, score), -min(k, len(at)), 1)
            floor = floor[:, -min(k, len(at))] if len(at) else np.empty(0)
            hit = score >= np.maximum(floor, best.bounds[plain])[:, None]
            rows, columns = np.nonzero(hit)
            best.offer(plain[rows], own[at][columns], score[rows, columns])
    return best


def found_rows(best: Best) -> pa.RecordBatch:
    columns = (best.ids[best.rows], best.names, best.scores)
    arrays = [pa.array(c, pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])


NAMES = ["ids", "cells", "bounds", "width"]


def searcher(k: int, vectors=None):
    """Blocks of queries with a group of vectors each, or all with the broadcast ``vectors``."""
    broadcast = vectors is not None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                value = {n: c[row].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                queries = unpacked(*(value[f"q_{n}"] for n in NAMES))
                groups = [vectors.value] if broadcast else [[value[f"v_{n}"] for n in NAMES]]
                for group in groups:
                    yield found_rows(search(queries, unpacked(*group), k))

    return run


def named(frame: DataFrame, prefix: str, key: str) -> DataFrame:
    return frame.select(key, *(F.col(n).alias(f"{prefix}_{n}") for n in NAMES))


def met(queries: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """The best of each query in every group that has vectors long enough.

    Which block meets which group is settled by two numbers, spread over as many buckets as
    there are groups; only then is anything sent.
    """
    many = max(1, groups.count())
    bucket = F.pmod(F.xxhash64("group"), F.lit(many))
    lengths = groups.select("group", "edge", bucket.alias("bucket"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(many - 1).cast("bigint")))
    spread = queries.select("block", F.col("edge").alias("needed"), every.alias("bucket"))
    near = F.col("edge") * (1 + 1e-9) >= F.col("needed")
    pairs = spread.join(lengths, "bucket").filter(near).select("block", "group")
    sent = pairs.join(named(queries, "q", "block"), "block").join(named(groups, "v", "group"), "group")
    return importable(sent.drop("block", "group")).mapInArrow(searcher(k), FOUND)


def blocks(queries: DataFrame) -> DataFrame:
    """Queries with a ``bound`` in numbered blocks; rows are dealt by a hash of their id."""
    packed = importable(queries).mapInPandas(packer(BLOCK, "bound"), PACKED)
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), "query-blocks")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id rank vec_id score``: the k highest products of each query, ranks from 1.

    Ties go to the smaller id. A query's own id is no candidate. Repeated rows count once; an
    id with different vectors is a candidate with each of them, and as a query gets the best
    over all of them. Vectors of unequal width count as padded with zeros. Queries with fewer than k candidates
    get all; empty tables give an empty result.
    """
    cells = stored(whole_numbers(vectors, vec_id, vector, scale).dropDuplicates(), "vectors")
    asked = stored(whole_numbers(queries, vec_id, vector, scale).dropDuplicates(), "queries")
    count = cells.count()
    if not count:
        empty = "query_id bigint, rank int, vec_id bigint, score bigint"
        return vectors.sparkSession.createDataFrame([], empty)
    size = BUCKET * GROUP
    many = -(-count // size)
    ordered = cells.repartitionByRange(many, F.desc("length"), "vec_id")
    ordered = ordered.sortWithinPartitions(F.desc("length"), "vec_id")
    packed = importable(ordered).mapInPandas(packer(size, "length"), PACKED)
    groups = stored(packed.withColumn("group", F.monotonically_increasing_id()), "buckets")
    # First bounds: each query against the longest vectors, a fixed number.
    longest = cells.orderBy(F.desc("length"), "vec_id").limit(BUCKET).toPandas()
    longest = pack(longest, longest["length"].to_numpy(np.float64))
    sent = vectors.sparkSession.sparkContext.broadcast([longest[n] for n in NAMES])
    spread = asked.repartition(max(1, -(-count // (size * 4))), "vec_id")
    unbound = blocks(spread.withColumn("bound", F.lit(float("-inf"))))
    found = importable(named(unbound, "q", "block")).mapInArrow(searcher(k, sent), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bounds = found.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when(F.count("*") >= k, F.min("score").cast("double")).alias("bound")
    )
    bound = F.coalesce("bound", F.lit(float("-inf")))
    known = spread.join(bounds, "vec_id", "left").withColumn("bound", bound)
    ranked = met(blocks(known), groups, k).withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
