from collections import Counter, defaultdict

import numpy as np
import pytest

from precinct.llm import mixing
from tests.llm.conftest import EDGES, words


def test_targets_by_weight_and_cap():
    assert mixing.targets([100, 100, 100], [1, 2, 3], 3) == pytest.approx([50, 100, 150])
    # The second source is full at 3 times its words; the rest goes by weight.
    got = mixing.targets([100, 10, 100], [1, 2, 3], 3)
    assert got == pytest.approx([45, 30, 135])
    assert sum(mixing.targets([1, 1, 1000], [5, 5, 1], 3)) == pytest.approx(1002)


def test_permutations_hit_each_index_once():
    for size in (1, 2, 3, 5, 16, 17, 1000):
        for key in (1, 2):
            got = mixing.permuted(
                np.arange(size), np.full(size, size), np.full(size, key, np.uint64)
            )
            assert sorted(got.tolist()) == list(range(size))


def test_draws_use_all_slots_in_order():
    slots = [100, 0, 37, 900]
    out = mixing.draws(slots, 7, 1)
    for source, want in enumerate(slots):
        runs = [(first, n) for _, i, first, n in out if i == source]
        at = 0
        for first, n in runs:
            assert first == at
            at += n
        assert at == want
    sizes = Counter()
    for shard, _, _, n in out:
        sizes[shard] += n
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert mixing.draws([], 0, 1) == []


def mixed_docs(make_docs):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{i}x{k}" for k in range(rng.integers(0, 90))) for i in range(400)]
    sources = [["a", "b", None, "d"][min(3, int(rng.integers(0, 8)))] for _ in texts]
    return texts, sources, make_docs(texts, source=sources)


def test_words_taken_follow_the_targets(make_docs):
    texts, sources, docs = mixed_docs(make_docs)
    rows = mixing.words_taken(*mixing.mix(docs, block_words=32), block_words=32).collect()
    assert len(rows) == 400
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for row in rows:
        own = sources[row["doc_id"]]
        assert row["size"] == len(words(texts[row["doc_id"]]))
        assert 0 <= row["taken"] <= 3 * row["size"]
        size[own] += row["size"]
        taken[own] += row["taken"]
        target[own] = row["target"]
        assert row["target"] <= 3 * row["source_size"]
    names = sorted(size, key=lambda s: (s is None, s or ""))
    want = mixing.targets([size[n] for n in names], [1, 2, 3, 1], 3)
    for name, expected in zip(names, want):
        assert target[name] == pytest.approx(expected)
        assert abs(taken[name] - expected) <= 3 * 32 + 1
    again = mixing.words_taken(*mixing.mix(docs.repartition(3), block_words=32), block_words=32)
    assert {r["doc_id"]: r["taken"] for r in again.collect()} == (
        {r["doc_id"]: r["taken"] for r in rows}
    )


def test_small_sources_reach_their_targets(make_docs):
    """Sources of 1 to 1,000 words, against targets worked out one by one."""
    sizes = [1, 2, 5, 17, 50, 100, 127, 128, 129, 200, 255, 256, 257, 400, 640, 999, 1000, 30_000]
    texts = [" ".join(f"s{i}w{k}" for k in range(n)) for i, n in enumerate(sizes)]
    names = [f"s{i:02d}" for i in range(len(sizes))]
    docs = make_docs(texts, source=names)
    rows = mixing.words_taken(*mixing.mix(docs)).collect()
    # Shares by weight; what is beyond three times a source's words goes to the others.
    left, open_sources, target = float(sum(sizes)), set(range(len(sizes))), {}
    while True:
        weight = sum(i % 3 + 1 for i in open_sources)
        full = [i for i in open_sources if left * (i % 3 + 1) / weight > 3 * sizes[i]]
        if not full:
            break
        target |= {i: 3 * sizes[i] for i in full}
        left -= sum(3 * sizes[i] for i in full)
        open_sources -= set(full)
    target |= {i: left * (i % 3 + 1) / weight for i in open_sources}
    for row in rows:
        want = target[row["doc_id"]]
        assert row["target"] == pytest.approx(want)
        assert abs(row["taken"] - want) <= max(mixing.BLOCK_WORDS, 0.02 * want)
        assert row["taken"] <= 3 * row["size"]
        if want == 3 * row["size"]:
            assert row["taken"] == want


def test_the_mix_is_made_of_blocks(make_docs):
    texts, sources, docs = mixed_docs(make_docs)
    known, taken = mixing.mix(docs, block_words=32)
    rows = mixing.mixed_documents(docs, known, taken, 32).collect()
    counted = Counter()
    blocks = defaultdict(int)
    for row in rows:
        assert row["text"] in texts[row["doc_id"]]
        assert row["source"] == sources[row["doc_id"]]
        counted[row["doc_id"]] += len(words(row["text"]))
        blocks[row["shard"], row["source"], row["slot"]] += len(words(row["text"]))
    want = {r["doc_id"]: r["taken"] for r in mixing.words_taken(known, taken, 32).collect()}
    assert counted == Counter({k: v for k, v in want.items() if v})
    assert max(blocks.values()) == 32
    assert sum(n < 32 for n in blocks.values()) <= 3 * 4


def test_edges(edges, nothing):
    rows = mixing.words_taken(*mixing.mix(edges)).collect()
    assert len(rows) == len(EDGES)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    clashing = edges.selectExpr("*", "'x' AS shard", "1 AS first", "2 AS block")
    known, taken = mixing.mix(clashing)
    whole = mixing.mixed_documents(clashing, known, taken).collect()
    got = sum(len(words(r["text"])) for r in whole)
    assert got == sum(r["taken"] for r in mixing.words_taken(known, taken).collect())
    assert mixing.words_taken(*mixing.mix(nothing)).count() == 0
    assert mixing.mixed_documents(nothing, *mixing.mix(nothing)).count() == 0
