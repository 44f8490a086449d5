import random

import numpy as np

from precinct.llm import compression_quality as quality
from precinct.llm.common import held_out
from tests.llm.conftest import EDGES

LABELS = "doc_id bigint, quality int, toxic int"


def labelled(spark, make_docs, count=600):
    rng = random.Random(3)
    parts = "ka lo mi tu re sa ve no".split()
    texts, labels = [], []
    for i in range(count):
        good = rng.random() < 0.7
        text = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 200))]
        texts.append(" ".join(text) if good else " ".join(w.upper() + "!!" for w in text))
        labels.append((i, int(good), None))
    return make_docs(texts), spark.createDataFrame(labels, LABELS), dict(l[:2] for l in labels)


def test_good_and_bad_are_told_apart(spark, make_docs):
    docs, labels, truth = labelled(spark, make_docs)
    model = quality.fit(docs, labels, ~held_out("doc_id", 5, 0))
    assert model.good and model.bad and model.slope > 0
    rows = quality.score(docs, model).join(docs.select("doc_id"), "doc_id").collect()
    assert len(rows) == 600
    right = [(r["score"] >= 0.3) == bool(truth[r["doc_id"]]) for r in rows]
    assert np.mean(right) > 0.98


def test_scores_do_not_depend_on_held_out_labels(spark, make_docs):
    docs, labels, _ = labelled(spark, make_docs, 300)
    usable = ~held_out("doc_id", 5, 0)
    turned = labels.withColumn(
        "quality", quality.F.when(usable, quality.F.col("quality")).otherwise(1 - quality.F.col("quality"))
    )
    assert quality.fit(docs, labels, usable) == quality.fit(docs, turned, usable)


def test_whole_texts_count():
    good, bad = quality.dictionaries(["lorem ipsum dolor sit amet " * 30] * 40, ["XX ## !! YY " * 40] * 40)
    start = b"lorem ipsum dolor sit amet " * 200
    assert quality.difference(start, good, bad) != quality.difference(
        start + b"XX ## !! YY " * 2_000, good, bad
    )


def test_edges(spark, edges, nothing):
    none = spark.createDataFrame([], LABELS)
    model = quality.fit(edges, none, held_out("doc_id", 5, 0))
    rows = quality.score(edges, model).collect()
    assert len(rows) == len(EDGES) and {r["score"] for r in rows} == {0.5}
    odd = spark.createDataFrame([(1, 1, 0), (2, None, 0), (3, 7, 0), (None, 0, 0), (5, 0, 1)], LABELS)
    model = quality.fit(edges, odd, ~held_out("doc_id", 5, 3))
    assert all(0 <= r["score"] <= 1 for r in quality.score(edges, model).collect())
    assert quality.score(nothing, model).count() == 0
