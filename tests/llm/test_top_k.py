import math

import numpy as np
import pytest

from precinct.llm import top_k as search

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, queries, k, scale=256):
    cells = {}
    for i, x, *_ in rows:
        if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            cells[i] = [math.floor(scale * float(np.float32(c))) for c in x]
    out = []
    for q in queries:
        if q in cells:
            found = sorted(
                (-sum(a * b for a, b in zip(cells[q], c)), i) for i, c in cells.items() if i != q
            )
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def check(spark, rows, step, k=5):
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = search.top_k(vectors, vectors.filter(f"vec_id % {step} = 0"), k=k).collect()
    queries = sorted({i for i, *_ in rows if i is not None and i % step == 0})
    assert sorted(map(tuple, got)) == brute(rows, queries, k)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(search, "BUCKET", 16)
    monkeypatch.setattr(search, "GROUP", 2)
    monkeypatch.setattr(search, "BLOCK", 8)


def test_lengths_of_all_sizes(spark, small_blocks):
    rng = np.random.default_rng(1)
    rows = [
        (i, (rng.normal(size=8) * 10 ** rng.uniform(-2, 2)).tolist(), 0) for i in range(400)
    ]
    check(spark, rows, 10)


def test_close_vectors_and_ties(spark, small_blocks):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(400):
        x = centres[i % 6] + rng.normal(size=12) * 0.01 * (i % 3)
        rows.append((i, (x / np.linalg.norm(x)).tolist(), 0))
    check(spark, rows, 10)


def test_pruning_by_coordinates_loses_nothing():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(2_000, 6))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    for row in range(50):
        query = unit[row]
        for cosine in (0.75, 0.9, 0.99, 1.0):
            keep = search.feasible(unit, query, cosine)
            assert keep[unit @ query >= cosine].all()
    assert search.feasible(unit, unit[0], 0.95).mean() < 0.3


def test_edges(spark):
    rows = [
        (0, [1.0, 2.0], 0),
        (1, None, 0),
        (2, [1.0, None], 0),
        (3, [float("nan"), 1.0], 0),
        (4, [float("inf"), 1.0], 0),
        (5, [0.0, 0.0], 0),
        (6, [], 0),
        (10, [-1.0, 0.5], 0),
        (20, [0.001, -0.001], 0),
        (None, [1.0, 1.0], 0),
    ]
    check(spark, rows, 10)
    check(spark, rows[:1], 10)
    empty = spark.createDataFrame([], SCHEMA)
    assert search.top_k(empty, empty).count() == 0


def test_repeated_rows_count_once(spark):
    rows = [(i, [float(i), 1.0], 0) for i in (0, 1, 2, 3)]
    vectors = spark.createDataFrame(rows + rows, SCHEMA)
    got = search.top_k(vectors, vectors.filter("vec_id = 0"), k=5).collect()
    assert sorted(map(tuple, got)) == brute(rows, [0], 5)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(2**19 - 3 * i)], 0) for i in range(12)]
    check(spark, rows, 4)


def test_no_cross_join_and_pruned_pairs(spark, small_blocks):
    """Long and short vectors: most groups are too short for the bounds and are not sent."""
    rng = np.random.default_rng(6)
    rows = [
        (i, (rng.normal(size=8) * (100.0 if i < 40 else 0.1)).tolist(), 0) for i in range(600)
    ]
    check(spark, rows, 50)
    vectors = spark.createDataFrame(rows, SCHEMA)
    frame = search.top_k(vectors, vectors.filter("vec_id % 50 = 0"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan

    cells = search.stored(search.whole_numbers(vectors, "vec_id", "embedding", 256), "vectors")
    ordered = cells.repartitionByRange(20, search.F.desc("length"), "vec_id")
    packed = ordered.sortWithinPartitions(search.F.desc("length")).mapInPandas(
        search.packer(32, "length"), search.PACKED
    )
    groups = search.stored(packed.withColumn("group", search.F.monotonically_increasing_id()), "g")
    known = cells.filter("vec_id % 50 = 0 AND vec_id < 40").withColumn("bound", search.F.col("length") * 200.0)
    blocks = search.blocks(known)
    needed = blocks.select("edge").collect()
    edges = [r["edge"] for r in groups.select("edge").collect()]
    assert 0 < sum(e >= min(n["edge"] for n in needed) for e in edges) < len(edges) / 2
