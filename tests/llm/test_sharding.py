import random
import zlib
from collections import defaultdict

from precinct.llm.sharding import CapacityTree, pack, pack_into, shard_documents
from tests.llm.conftest import EDGES


def plain_best_fit(sizes, capacity):
    rooms, places = [], []
    for size in sizes:
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fitting:
            _, at = min(fitting)
        else:
            rooms.append(max(capacity, size))
            at = len(rooms) - 1
        rooms[at] -= size
        places.append(at)
    return places


def test_packing_is_best_fit():
    rng = random.Random(5)
    for _ in range(50):
        sizes = sorted((rng.randint(1, 60) for _ in range(rng.randint(0, 300))), reverse=True)
        assert pack(sizes, 50) == plain_best_fit(sizes, 50)


def test_tree_with_many_bins(monkeypatch):
    monkeypatch.setattr(CapacityTree, "WIDTH", 2)
    rng = random.Random(6)
    sizes = sorted((rng.randint(1, 99) for _ in range(2_000)), reverse=True)
    assert pack(sizes, 100) == plain_best_fit(sizes, 100)


def test_smallest_capacity():
    sizes = sorted([7, 6, 5, 5, 4, 3, 3, 2, 1], reverse=True)
    places = pack_into(sizes, 3)
    load = defaultdict(int)
    for size, place in zip(sizes, places):
        load[place] += size
    assert max(load.values()) == 12 and len(load) == 3
    assert pack_into([], 3) == [] and pack_into([4], 3) == [0]


def loads_of(sizes, bins):
    load = [0] * bins
    for size, place in zip(sizes, pack_into(sizes, bins)):
        load[place] += size
    return load


def test_items_above_the_share_leave_the_other_bins_even():
    load = loads_of([1000] + [1] * 2000, 16)
    assert load[0] == 1000 and max(load[1:]) == 134 and min(load[1:]) >= 120
    load = loads_of([5000, 900, 300] + [1] * 1000, 12)  # 300 is above the share of what is left
    assert load[:3] == [5000, 900, 300] and max(load[3:]) == 112 and min(load[3:]) >= 104
    assert sorted(loads_of([9, 1], 4)) == [0, 0, 1, 9]


def test_a_group_of_a_third_of_the_bytes(make_docs):
    texts = ["the same text " * 8] * 200 + [f"{i:05d}" + "y" * 40 for i in range(1_000)]
    rows = shard_documents(make_docs(texts), shards=16).collect()
    check(rows, 16, dict(enumerate(texts)))
    load = defaultdict(int)
    for row in rows:
        load[row["shard"]] += row["size"]
    rest = sorted(load.values())[:-1]
    assert len(load) == 16 and max(rest) <= sum(rest) / 15 + 46 and min(rest) >= 0.9 * max(rest)


def check(rows, shards, texts):
    by_shard = defaultdict(list)
    of_text = {}
    for row in rows:
        text = texts[row["doc_id"]]
        assert row["size"] == len((text or "").encode()) + 1
        assert row["text_crc32"] == zlib.crc32((text or "").encode())
        assert of_text.setdefault(text, row["shard"]) == row["shard"]
        by_shard[row["shard"]].append(row["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert set(by_shard) <= set(range(shards))


def test_groups_stay_together_and_sizes_are_near_equal(make_docs):
    rng = random.Random(9)
    texts = ["x" * rng.randint(0, 400) + str(i) for i in range(600)] + ["copy" * 20] * 150
    rows = shard_documents(make_docs(texts), shards=4).collect()
    check(rows, 4, dict(enumerate(texts)))
    load = defaultdict(int)
    for row in rows:
        load[row["shard"]] += row["size"]
    assert max(load.values()) - min(load.values()) < 0.02 * sum(load.values())
    again = shard_documents(make_docs(texts[::-1]), shards=4)
    assert again.count() == len(texts)


def test_capacity_decides_the_number_of_shards(make_docs):
    texts = [f"{i:099d}" for i in range(40)]
    rows = shard_documents(make_docs(texts), capacity=500).collect()
    assert {r["shard"] for r in rows} == set(range(8))


def test_edges(edges, nothing):
    rows = shard_documents(edges, shards=3).collect()
    assert len(rows) == len(EDGES)
    check(rows, 3, {i: t for i, t, *_ in EDGES})
    assert shard_documents(nothing).count() == 0
