import random

import numpy as np
import pyarrow as pa
import pytest

from precinct.llm import common, near_join
from precinct.llm.components import components
from precinct.llm.near_join import near_components
from precinct.llm.shingles import Scheme, digests, shingle_sets
from tests.llm.conftest import EDGES, words


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_set(text, width):
    w = words(lower(text))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(texts, width, percent):
    sets = {i: plain_set(t, width) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                one, two = root(a), root(b)
                parent[max(one, two)] = min(one, two)
    return sorted((i, len(sets[i]), root(i)) for i in ids)


def copies(seed, groups=12, size=14, length=120, noise=6):
    """Groups of near copies of a base, from a few changes to many, and unrelated texts."""
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 500)}" for _ in range(rng.randint(8, length))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, size)):
            own = list(base)
            for _ in range(rng.randint(0, noise)):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 10**6)}"
            out.append(" ".join(own))
        out.append(" ".join(f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 40))))
    rng.shuffle(out)
    return out


def got(frame):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in frame.collect())


def test_sets_are_those_of_a_plain_version():
    texts = [*copies(1, groups=3), "", " \n", "One", "one TWO", "a b c", "a b c d", "é É a\x0bb", "a a a a a a"]
    hashes, sizes = shingle_sets([t.encode() for t in texts], 4)
    assert sizes.tolist() == [len(plain_set(t, 4)) for t in texts]
    ends = np.cumsum(sizes)
    own = [set(hashes[e - n : e].tolist()) for e, n in zip(ends, sizes)]
    for i in range(0, len(texts), 3):
        for j in range(len(texts)):
            assert len(own[i] & own[j]) == len(plain_set(texts[i], 4) & plain_set(texts[j], 4))
    marks = digests(hashes, sizes).tolist()
    assert len(set(marks)) == len({frozenset(plain_set(t, 4)) for t in texts})


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_similar_sets_share_enough_parts(percent):
    rng = random.Random(percent)
    scheme = Scheme(percent)
    for _ in range(300):
        n = rng.choice([6, 7, 15, 16, 31, 33, 60, 130, 255, 400])
        base = [rng.getrandbits(64) for _ in range(n)]
        other = list(base)
        for _ in range(n):
            spot = rng.randrange(len(other)) if other else 0
            tried = list(other)
            step = rng.randrange(3)
            if step == 0 and len(tried) > 1:
                del tried[spot]
            elif step == 1:
                tried[spot] = rng.getrandbits(64)
            else:
                tried.append(rng.getrandbits(64))
            a, b = set(base), set(tried)
            if 100 * len(a & b) < percent * len(a | b):
                break
            other = tried
        pair = [sorted(set(base)), sorted(set(other))]
        sizes = np.array([len(x) for x in pair])
        values, owner, classes, need = scheme.signatures(
            np.array(pair[0] + pair[1], np.uint64), sizes
        )
        if pair[0] == pair[1]:
            continue
        met = False
        for one in set(classes[owner == 0].tolist()) & set(classes[owner == 1].tolist()):
            own = [set(values[(owner == i) & (classes == one)].tolist()) for i in (0, 1)]
            least = [need[(owner == i) & (classes == one)].max() for i in (0, 1)]
            met |= len(own[0] & own[1]) >= max(1, *least)
        assert met


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_exact(make_docs, seed):
    texts = copies(seed)
    assert got(near_components(make_docs(texts))) == brute(dict(enumerate(texts)), 4, 85)


def test_one_large_group_in_many_regions_and_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(near_join, "PIVOTS", 3)
    texts = copies(5, groups=2, size=120, length=90, noise=9)
    found = near_components(make_docs(texts), large=400, block=300)
    assert got(found) == brute(dict(enumerate(texts)), 4, 85)


def loose_group(members, seed=3, length=200):
    """One group of texts around a base, most of them too far from each other to be linked."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(length)]
    out = []
    for n in range(members):
        own = list(base)
        for _ in range(rng.choice([0, 1, 4, 5, 6, 7])):
            own[rng.randrange(length)] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


def test_a_large_group_moves_few_whole_sets(make_docs, monkeypatch):
    """Only sketches are copied to pairs of blocks; a set goes to where it may have a link."""
    moved = []

    def counting(frame):
        if {"pair", "cells"} <= set(frame.columns):
            moved.append(frame.count())
        return common.importable(frame)

    monkeypatch.setattr(near_join, "importable", counting)
    monkeypatch.setattr(near_join, "SKETCHED", 3, raising=False)
    texts = loose_group(80)
    found = near_components(make_docs(texts), block=1_000)
    assert got(found) == brute(dict(enumerate(texts)), 4, 85)
    assert sum(moved) < 5 * len(texts)


def test_sketches_tell_no_similar_sets_apart():
    rng = np.random.default_rng(4)
    for n in (1, 5, 31, 33, 400):
        base = rng.integers(-(2**63), 2**63 - 1, n + n // 2, dtype=np.int64)
        for less in range(n // 2):
            one, two = base[:n], base[less:]
            bits = sorted((near_join.parity(x) for x in (one, two)), key=len)
            short, long = (np.frombuffer(x, np.uint64) for x in bits)
            while len(long) > len(short):
                long = long[: len(long) // 2] ^ long[len(long) // 2 :]
            differ = int(np.bitwise_count(short ^ long).sum())
            assert differ <= len(np.setxor1d(one, two))


def test_members_are_measured_against_all_pivots_of_their_region(spark):
    cells = {1: [1, 2, 3], 2: [2, 3, 4, 5], 3: [9], 4: [1, 9]}
    sets = spark.createDataFrame(list(cells.items()), "id bigint, cells array<bigint>")
    inside = spark.createDataFrame([(7, 1), (7, 2), (8, 3), (8, 4)], "region bigint, id bigint")
    pivots = spark.createDataFrame([(7, 2), (7, 4), (8, 3)], "region bigint, pivot bigint")
    rows = near_join.measured_around(inside, pivots, sets).collect()
    found = {(r["region"], r["id"], r["pivot"]): (r["n"], r["m"], r["common"]) for r in rows}
    assert found == {
        (region, i, pivot): (len(cells[i]), len(cells[pivot]), len({*cells[i]} & {*cells[pivot]}))
        for region, i, pivot in [(7, 1, 2), (7, 1, 4), (7, 2, 2), (7, 2, 4), (8, 3, 3), (8, 4, 3)]
    }


def test_other_widths_and_thresholds(make_docs):
    texts = copies(8, groups=6, noise=4)
    found = near_components(make_docs(texts), words=5, percent=80)
    assert got(found) == brute(dict(enumerate(texts)), 5, 80)


def got_of_rows(frame):
    rows = ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in frame.collect())
    return sorted(rows, key=repr)


def brute_of_rows(rows, width, percent):
    """Components of rows whose ids may be null or repeated, by their smallest id."""
    found = brute({n: t for n, (_, t) in enumerate(rows)}, width, percent)
    names = {}
    for n, _, component in found:
        if rows[n][0] is not None:
            names[component] = min(rows[n][0], names.get(component, rows[n][0]))
    return sorted(((rows[n][0], size, names.get(c)) for n, size, c in found), key=repr)


def test_ids_that_are_null_or_repeated(spark):
    """An id that two texts share is no link between them."""
    one = " ".join(f"a{i}" for i in range(60))
    two = " ".join(f"b{i}" for i in range(60))
    rows = [
        (0, one), (1, one + " x"), (1, two), (5, two + " y"), (None, one + " z"),
        (None, "c d e f g h"), (9, "c d e f g h"), (None, ""), (7, None), (7, "only here"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = got_of_rows(near_components(frame.repartition(3)))
    assert found == brute_of_rows(rows, 4, 85)
    assert {(i, c) for i, _, c in found} >= {(0, 0), (1, 0), (1, 1), (5, 1), (None, 0), (None, 9)}


def test_edges(edges, nothing, spark):
    rows = got_of_rows(near_components(edges.selectExpr("*", "1 AS n", "2 AS id", "3 AS pivot", "4 AS key")))
    assert rows == brute_of_rows([(i, t) for i, t, *_ in EDGES], 4, 85)
    assert near_components(nothing).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7), (51, 52)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r["id"]: r["component"] for r in components(frame).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 0 for i in range(50)} | {51: 51, 52: 51}
    assert found == want
    assert components(frame.limit(0)).count() == 0


def test_workers_get_small_batches_and_forget_their_table(spark):
    """An executor's workers hold a batch per task, and nothing of an operator that is done."""
    def sizes(batches):
        for batch in batches:
            common.worker_table("table", lambda: [0])
            common.worker_table(None, None)
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "kept": [len(common._kept)]})

    rows = spark.range(3 * common.BATCH_ROWS).coalesce(1)
    found = common.importable(rows).mapInArrow(sizes, "n bigint, kept bigint").collect()
    assert [row["n"] for row in found] == [common.BATCH_ROWS] * 3
    assert {row["kept"] for row in found} == {0}
