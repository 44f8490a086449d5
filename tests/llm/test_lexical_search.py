import math
import re
from collections import Counter

import pytest

from precinct.llm import lexical_search
from precinct.llm.lexical_search import search

DOCS = "doc_id bigint, text string, item_id string"
ITEMS = "item_id bigint, text string, doc_id string"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in re.findall(TERM, text or "")]


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, c in counted:
            m = 100 - 90 + (90 * c.total() * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, no_id, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, None if no_id else doc_id, -score))
    return sorted(out, key=repr)


CORPUS = [
    (1, "the cat sat on the mat", ""),
    (2, "the CAT sat; on the mat!", ""),
    (3, "dogs and cats", ""),
    (4, None, None),
    (5, " \n\t?", None),
    (6, "cat", None),
    (6, "cat", None),
    (6, "zażółć gęślą jaźń 12 naïve", None),
    (None, "cat", None),
    (None, "the mat", None),
    (7, "cat " * 300 + "the mat", None),
    (8, "12\x0012 ab\x7fab", None),
]
QUESTIONS = [
    (1, "Cat, cat and the mat", None),
    (2, "NAÏVE naïve 12 JAŹŃ jaźń", None),
    (3, None, None),
    (4, "--", None),
    (5, "unknown", None),
    (5, "ab", None),
    (None, "dogs", None),
    (1, "Cat, cat and the mat", "again"),
]


@pytest.mark.parametrize("most", [1 << 20, 100])
@pytest.mark.parametrize("k", [1, 3, 10])
def test_equals_brute_force(spark, most, k):
    docs, items = spark.createDataFrame(CORPUS, DOCS), spark.createDataFrame(QUESTIONS, ITEMS)
    got = search(docs.repartition(5), items, k=k, most=most)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute([d[:2] for d in CORPUS], [q[:2] for q in QUESTIONS], k)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_many_documents_and_ties(spark):
    docs = [(i, f"{'x ' * (i % 7)}y{i % 11} word", "") for i in range(500)]
    items = [(i, f"x y{i} word", "") for i in range(12)]
    got = search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    want = brute([d[:2] for d in docs], [q[:2] for q in items], 10)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_edges(spark, edges, nothing):
    items = spark.createDataFrame([(1, "word5 story", ""), (2, "five", "")], ITEMS)
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    want = brute(rows, [(1, "word5 story"), (2, "five")], 10)
    assert sorted(map(tuple, search(edges, items).collect()), key=repr) == want
    assert search(nothing, items).count() == 0
    assert search(edges, spark.createDataFrame([], ITEMS)).count() == 0


def test_heaps_stay_bounded():
    import numpy as np

    best = lexical_search.Best(2, 3)
    rng = np.random.default_rng(1)
    all_scores = rng.integers(0, 50, (1_000, 2))
    for doc_id, scores in enumerate(all_scores):
        best.offer(doc_id, scores)
    for item in range(2):
        want = sorted(((-s, d) for d, s in enumerate(all_scores[:, item]) if s > 0))[:3]
        assert sorted((-s, -d) for s, _, d in best.heaps[item]) == want
