import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from precinct.llm import items as items_module
from precinct.llm.decontamination import Item, Patterns, Search, clean, passages

ITEMS = "item_id bigint, text string, more string"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(WORD, lower)


def brute(docs, items, width):
    """Every window of every item, tried at every word of every document."""
    out = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item_id, item in items:
            own = words_of(item)
            size = min(width, len(own))
            for b in range(len(own) - size + 1 if size else 0):
                for at in range(len(words) - size + 1):
                    if words[at : at + size] == own[b : b + size]:
                        hit |= set(range(at, at + size))
                        found.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(words), tuple(sorted(hit)), tuple(sorted(found))))
    return sorted(out, key=repr)


def rows(frame):
    got = []
    for r in frame.collect():
        spans = [(s["begin"], s["end"]) for s in r["spans"]]
        assert spans == sorted(spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        hit = tuple(p for b, e in spans for p in range(b, e))
        got.append((r["doc_id"], r["n_words"], hit, tuple(r["items"])))
    return sorted(got, key=repr)


CORPUS = [
    (1, "We said: the QUICK brown-fox jumps over the lazy dog today, and the quick brown fox."),
    (2, "the quick brown fox jumps the quick brown fox jumps over"),
    (3, None),
    (4, ""),
    (5, " \t\n-- ?"),
    (6, "Straße 東京 straße 東京 straße"),
    (6, "Straße 東京 straße 東京 straße"),
    (6, "a b a b a b a"),
    (None, "yes, the quick brown fox jumps"),
    (7, "nothing of it"),
]
QUESTIONS = [
    (10, "The quick brown fox jumps over the lazy dog", "x"),
    (2, "quick brown fox jumps", "x"),
    (3, "Straße 東京", None),
    (3, "东", None),
    (4, None, None),
    (5, "?!", None),
    (6, "a b a", None),
    (7, "today", None),
    (None, "nothing", None),
    (2, "quick brown fox jumps", "again"),
]


@pytest.mark.parametrize("most", [1 << 20, 150])
def test_equals_brute_force(spark, most):
    docs = spark.createDataFrame(CORPUS, "doc_id bigint, text string")
    docs = docs.selectExpr("*", "1 AS digest", "'x' AS items", "text AS data")
    questions = spark.createDataFrame(QUESTIONS, ITEMS)
    got = passages(docs, questions, width=4, most=most)
    assert got.columns == ["doc_id", "n_words", "spans", "items"]
    assert rows(got) == brute(CORPUS, [q[:2] for q in QUESTIONS], 4)


def test_clean_keeps_rows_and_columns(spark, edges):
    questions = spark.createDataFrame([(1, "two three four", ""), (2, "no id", "")], ITEMS)
    for most in (1 << 20, 70):
        kept = clean(edges, questions, width=3, most=most)
        assert kept.columns == edges.columns
        assert kept.count() == edges.count() - 2
        assert kept.exceptAll(edges).count() == 0


def test_edges(spark, edges, nothing):
    questions = spark.createDataFrame([(1, "story word39 of", "")], ITEMS)
    got = {(r["doc_id"], r["n_words"]): r for r in passages(edges, questions).collect()}
    assert len(got) == edges.distinct().count()
    long = got[(7, 160_000)]
    assert long["items"] == ["1"] and len(long["spans"]) == 41
    none = spark.createDataFrame([], ITEMS)
    assert all(not r["spans"] for r in passages(edges, none).collect())
    assert passages(nothing, questions).count() == 0
    assert clean(nothing, none).count() == 0


def test_occurrences_over_the_ends_of_runs(monkeypatch):
    text = "x a b c d e f g h i j " * 50
    item = Item(0, "1", b"a b c d e f g h i j")
    whole = Search([item], 10).scan(text.encode())
    assert whole[0] == 550 and len(whole[1]) == 50
    for piece in (1, 7, 40):
        monkeypatch.setattr(items_module.term_runs, "__defaults__", (piece,))
        assert Search([item], 10).scan(text.encode()) == whole


def test_skips_most_positions():
    window = tuple(b"w%d" % i for i in range(10))

    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

    patterns = Patterns(10, {window: {"1"}})
    patterns.shifts = Counted(patterns.shifts)
    text = [b"z"] * 9_000 + list(window) + [b"z"] * 9_000
    assert [b for b, _ in patterns.occurrences(text)] == [9_000]
    assert Counted.asked < 18_010 / 8


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.sampled_from("abAB1é-"), max_size=40),
    st.lists(st.lists(st.sampled_from("aBé "), max_size=8), max_size=4),
    st.integers(1, 5),
)
def test_any_texts(text, questions, width):
    text = " ".join(text)
    asked = [(i, " ".join(q)) for i, q in enumerate(questions)]
    search = Search([Item(i, str(i), q.encode()) for i, q in asked], width)
    n, spans, found = search.scan(text.encode())
    hit = tuple(p for b, e in spans for p in range(b, e))
    assert (0, n, hit, tuple(found)) == brute([(0, text)], asked, width)[0]
