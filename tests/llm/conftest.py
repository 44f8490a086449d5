import re

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Rows that every operator has to bear: nulls, empty and blank texts, repeats, a long text.
LONG = " ".join(f"word{i % 977} of the story," for i in range(40_000))
EDGES = [
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (3, " \t\n\r\x0b\x0c ", "en", "a", 7),
    (4, "one", "en", "b", 3),
    (5, "one", "en", "b", 3),
    (5, "one", "en", "b", 3),
    (6, "ONE two  three\nfour five", "en", None, 22),
    (7, LONG, "en", "a", len(LONG)),
    (8, "+++ 123 \U0001f600 \x00 é", None, "a", 12),
    (None, "no id here", None, "a", 10),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def make_docs(spark):
    def make(texts, **columns):
        rows = []
        for i, text in enumerate(texts):
            lang = columns.get("lang", ["en"] * len(texts))[i]
            source = columns.get("source", ["a"] * len(texts))[i]
            rows.append((i, text, lang, source, len(text or "")))
        return spark.createDataFrame(rows, SCHEMA)

    return make
