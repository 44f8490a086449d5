import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from precinct.llm import hard_negatives as mining

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, block string"


def brute(rows, step, positives=5, negatives=10, low=30, high=90, scale=256):
    cells = [
        (i, k, [math.floor(scale * float(np.float32(c))) for c in x])
        for i, x, k in rows
        if i is not None and k is not None and x is not None
        if all(c is not None and math.isfinite(c) for c in x)
    ]
    out = []
    for a, (anchor, label, x) in enumerate(cells):
        if anchor % step:
            continue
        scored = [
            (-sum(p * q for p, q in zip(x, y)), i, k) for b, (i, k, y) in enumerate(cells) if b != a
        ]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            found = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p]
            for rank, (s, i, _) in enumerate(sorted(found)[:negatives], 1):
                out.append((anchor, positive, rank, i, -p, -s))
    return sorted(out)


def mined(spark, rows, step, **more):
    frame = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    return mining.hard_negatives(frame, F.col("vec_id") % step == 0, **more)


def check(spark, rows, step, **more):
    got = mined(spark, rows, step, **more)
    assert sorted(map(tuple, got.collect())) == brute(rows, step, **more)


@pytest.fixture
def small_packs(monkeypatch):
    monkeypatch.setattr(mining, "GROUP", 32)
    monkeypatch.setattr(mining, "BLOCK", 4)


def clustered(n, seed, noise=0.3, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, 8)) + 0.5
    return [
        (i, (centres[i % labels] + rng.normal(size=8) * noise * (1 + i % 3)).tolist(), i % labels)
        for i in range(n)
    ]


def test_clusters(spark, small_packs):
    check(spark, clustered(300, 1), 10)


def test_other_windows_and_numbers(spark, small_packs):
    check(spark, clustered(200, 2), 7, positives=2, negatives=3, low=-40, high=60)


def test_one_label_holds_most(spark, small_packs):
    rows = [(i, x, 0 if i % 10 else k) for i, x, k in clustered(250, 3)]
    check(spark, rows, 10)


def test_packs_are_bounded_however_rows_are_dealt(spark):
    rows = [(i, i, 0 if i % 3 else i % 40, [i, 1]) for i in range(900)]
    frame = spark.createDataFrame(rows, "row bigint, vec_id bigint, label bigint, cells array<bigint>")
    for parts in (1, 50):
        made = mining.packs(frame.repartition(parts, "row"), 64, "block", True).collect()
        sizes = [len(r["members"]) for r in made]
        assert sum(sizes) == 900 and max(sizes) <= 64
        assert len(made) <= 2 * 900 / 64
        assert sorted(m for r in made for m in r["members"]) == list(range(900))


def test_ties_and_repeated_rows(spark, small_packs):
    rows = [(i % 40, [float(i % 3), 1.0], i % 2) for i in range(120)]
    check(spark, rows, 8)


def test_edges(spark):
    rows = [
        (0, [1.0, 2.0], 0),
        (1, None, 0),
        (2, [1.0, None], 0),
        (3, [float("nan"), 1.0], 0),
        (4, [float("inf"), 1.0], 0),
        (5, [0.0, 0.0], 0),
        (6, [], 1),
        (7, [0.5, 0.9, 3.0], 1),
        (8, [0.5, 1.0], None),
        (None, [0.5, 1.0], 1),
        (10, [1.0, 1.9], 0),
        (11, [-1.0, -1.9], 1),
        (20, [-1.0, -2.0], 0),
    ]
    check(spark, rows, 10)
    check(spark, rows[:1], 10)
    check(spark, rows[5:8], 10)
    assert mined(spark, [], 10).count() == 0


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [
        (i, [float(2**20 + int(x)) for x in rng.integers(-5, 5, 3)], i % 2) for i in range(40)
    ]
    check(spark, rows, 4, low=90, high=100)


def pack(rows, with_tree):
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["row", "vec_id", "label", "cells"])
    return mining.unpack(mining.packer(with_tree)(frame).iloc[0].to_dict(), "")


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=16) * 100
    anchors = pack(
        [(i, i, 0, (centre + rng.normal(size=16)).astype(int)) for i in range(30)], True
    )
    others = [(100 + i, i, 1, (rng.normal(size=16) * 100).astype(int)) for i in range(500)]
    group = pack(others, False)
    exact = anchors.cells @ group.cells.T
    window = float(np.sort(exact[0])[-20])

    def choose(at, low, high):
        assert (low <= exact[at]).all() and (exact[at] <= high).all()
        return high >= window

    scored = mining.walk(anchors, group, choose, lambda at, spots, scores: None)
    assert scored < 0.3 * exact.size


def test_tree_is_of_least_length():
    cells = np.array([[0, 0], [10, 0], [1, 0], [9, 0], [5, 5]])
    order, parent, edge = mining.spanning_tree(cells)
    assert sorted(order.tolist()) == [0, 1, 2, 3, 4] and parent[order[0]] == -1
    place = {int(a): i for i, a in enumerate(order)}
    assert all(place[int(parent[a])] < place[int(a)] for a in order[1:])
    assert edge.sum() == pytest.approx(1 + 1 + 2 * math.hypot(4, 5), abs=0.01)
