import random

import numpy as np

from precinct.llm import language_id
from precinct.llm.common import held_out
from tests.llm.conftest import EDGES

SYLLABLES = {
    "aa": "ka lo mi tu re sa".split(),
    "bb": "ßen ung ver ich zwo älp".split(),
    "cc": "eau oix çon ét re mi".split(),
}


def prose(language, count, seed):
    rng = random.Random(f"{language}{seed}")
    word = lambda: "".join(rng.choices(SYLLABLES[language], k=rng.randint(1, 4)))
    return " ".join(word() for _ in range(count)).capitalize() + "."


def plain_phrases(text, sample):
    """Greedy longest matches, one by one."""
    count = at = 0
    while at < len(text):
        length = 0
        while at + length < len(text) and text[at : at + length + 1] in sample:
            length += 1
        at += max(1, length)
        count += 1
    return count


def test_automaton_accepts_all_substrings_and_no_more():
    sequence = [1, 2, 1, 1, 2, 2, 1, 2, 1]
    automaton = language_id.SuffixAutomaton(sequence)
    every = {tuple(sequence[i:j]) for i in range(9) for j in range(i + 1, 10)}
    rng = random.Random(1)
    for _ in range(500):
        some = tuple(rng.choices([1, 2], k=rng.randint(1, 6)))
        state = 0
        for symbol in some:
            state = automaton.next[state].get(symbol) if state is not None else None
        assert (state is not None) == (some in every)


def test_phrases_are_those_of_a_plain_parse():
    samples = tuple((name, prose(name, 60, 1)) for name in sorted(SYLLABLES))
    model = language_id.Model(samples)
    texts = [prose(name, 50, k) for name in SYLLABLES for k in range(3)]
    texts += ["", "zzz", "a", "Ka lo!"]
    rates, letters = model.rates(texts)

    def fold(text):
        out = "".join(c.lower() if c.isalpha() else " " for c in text + " ")
        while "  " in out:
            out = out.replace("  ", " ")
        return out

    for i, (_, sample) in enumerate(samples):
        for j, text in enumerate(texts):
            body = fold(text)
            if j == 0 or texts[j - 1]:
                assert letters[j] == sum(c.isalpha() for c in text)
            if len(body) > 1 and len(body) <= language_id.SEGMENT:
                want = plain_phrases(body, fold(sample))
                got = rates[i, j] * len(body) / model.bits[i]
                assert abs(got - want) < 1.01, (text, got, want)


def test_languages_are_told_apart(make_docs):
    names = [sorted(SYLLABLES)[i % 3] for i in range(300)]
    texts = [prose(n, 5 + i % 400, i) for i, n in enumerate(names)]
    docs = make_docs(texts, lang=names)
    samples = language_id.fit(docs, ~held_out("doc_id", 3, 1))
    rows = language_id.predict(docs.drop("lang"), samples).collect()
    right = [r["lang_pred"] == names[r["doc_id"]] for r in rows]
    assert len(rows) == 300 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(edges, nothing):
    english = "the story of one word and two or three"
    samples = (("en", english), ("xx", ("qz" * 20)[: len(english)]))
    rows = language_id.predict(edges.selectExpr("*", "1 AS score"), samples).collect()
    got = [(r["doc_id"], r["text"], r["lang_pred"]) for r in rows]
    # No sample has the one letter of document 8: the first language by name wins.
    want = [(i, t, "en" if any(c.isalpha() for c in t or "") else "und") for i, t, *_ in EDGES]
    assert got == want
    assert language_id.predict(nothing, samples).count() == 0
    assert language_id.fit(nothing, held_out("doc_id", 3, 0)) == ()
    none = language_id.predict(edges, ()).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
