import re
from collections import Counter

from precinct.llm.quality_rules import SYMBOLS, quality_rules
from tests.llm.conftest import words


def expected(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(SYMBOLS, text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def check(docs):
    got = quality_rules(docs).collect()
    for row in got:
        assert tuple(row[n] for n in NAMES) == expected(row["text"]), row["doc_id"]
        low = row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]
        assert row["base_failed"] == low
        assert not (row["base_failed"] and row["kept"])
    return got


def test_counts_are_those_of_a_plain_version(edges):
    assert len(check(edges)) == 10


def test_repeats_in_all_places(make_docs):
    texts = [
        "a b c a b c",
        "a a a a",
        "a a a",
        "x " * 500,
        "a b c d a b c e b c d",
        " ".join(f"w{i}" for i in range(300)) + " w7 w8 w9",
        " ".join(f"w{i % 60}" for i in range(300)),
        "same line\nsame line\n\nsame line \nother\n",
    ]
    check(make_docs(texts))


def test_natural_text_is_kept_and_junk_is_not(make_docs):
    good = " ".join(f"the house{i} of a man{i}" for i in range(20))
    junk = " ".join(f"{w}###" for w in good.split())
    rows = {r["doc_id"]: r["kept"] for r in check(make_docs([good, junk, good.upper()]))}
    assert rows == {0: True, 1: False, 2: False}


def test_empty_table_and_columns_of_the_same_name(nothing, make_docs):
    assert quality_rules(nothing).count() == 0
    docs = make_docs(["a b c"]).selectExpr("*", "1 AS kept", "2 AS _words", "3 AS n_words")
    row = quality_rules(docs).first()
    assert (row["n_words"], row["kept"], row["_words"]) == (3, False, 2)
