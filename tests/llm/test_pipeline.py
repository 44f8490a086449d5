from collections import Counter

import base64
import public_tokenizers
import tiktoken

import corpus_pipeline as pipeline
from precinct.llm.pseudonyms import Feistel, replace
from tests.llm.conftest import EDGES, SCHEMA, SMALL, words
from tests.llm.test_near_join import brute


def stage(name):
    return dict(pipeline.STAGES)[name]


def run_stages(spark, docs, tmp_path):
    """Each stage's input and result, written and read between stages."""
    out = []
    for i, (name, function) in enumerate(pipeline.STAGES):
        path = str(tmp_path / f"{i}-{name}")
        function(spark, docs, SMALL).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((name, [r.asDict() for r in docs.collect()], [r.asDict() for r in result.collect()]))
        docs = result
    return out


def check(results):
    cipher = Feistel(pipeline.KEY)
    with open(pipeline.TOKENIZER, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    for name, before, after in results:
        if name != "encoding":
            assert all(list(r) == pipeline.COLUMNS for r in after)
        key = lambda r: (r["doc_id"] is None, r["doc_id"], r["text"] or "")
        if name == "language":
            want = [r for r in before if any(c.isalpha() for c in r["text"] or "")]
            assert sorted(map(key, after)) == sorted(map(key, want))
        if name == "near_copies":
            # One row of each component of rows; where ids differ, that with the smallest.
            rows = sorted(before, key=lambda r: (r["doc_id"] is None, r["doc_id"]))
            component = {i: c for i, _, c in brute({i: r["text"] for i, r in enumerate(rows)}, 5, 80)}
            of = {}
            for i, r in enumerate(rows):
                of.setdefault(tuple(r.values()), set()).add(component[i])
            assert len(after) == len(set(component.values()))
            assert all(tuple(r.values()) in of for r in after)
            assert {c for r in after for c in of[tuple(r.values())]} == set(component.values())
            ids = [r["doc_id"] for r in before]
            if None not in ids and len(set(ids)) == len(ids):
                want = [r for i, r in enumerate(rows) if component[i] == i]
                assert sorted(map(key, after)) == sorted(map(key, want))
        if name == "personal_data":
            want = [r | {"text": replace(r["text"], cipher)[0]} for r in before]
            assert sorted(map(key, after)) == sorted(map(key, want))
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        if name == "mixing":
            whole = {}
            for r in before:
                whole.setdefault(r["doc_id"], []).append(r["text"])
            taken = Counter()
            for r in after:
                assert any(r["text"] in text for text in whole[r["doc_id"]])
                taken[r["doc_id"]] += len(words(r["text"]))
            for i, texts in whole.items():
                assert taken[i] <= 3 * sum(len(words(t)) for t in texts)
        if name == "encoding":
            want = Counter((r["doc_id"], tuple(library.encode_ordinary(r["text"]))) for r in before)
            assert Counter((r["doc_id"], tuple(r["ids"])) for r in after) == want


def test_stages_on_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    results = run_stages(spark, docs, tmp_path)
    check(results)
    assert len(results[1][2]) < len(results[1][1])


def test_stages_on_edges(spark, edges, nothing, tmp_path):
    check(run_stages(spark, edges, tmp_path))
    empty = run_stages(spark, nothing, tmp_path / "empty")
    assert all(not after for _, _, after in empty)
    assert len(EDGES) == 10 and SCHEMA
    assert {name for name, _ in pipeline.STAGES} == {
        "language", "near_copies", "personal_data", "mixing", "encoding"
    }


def test_run_is_all_stages(spark):
    rows = pipeline.run(spark, SMALL)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert rows.count() > 0


def test_rows_that_share_ids_are_not_lost_or_changed(spark, tmp_path):
    """Repeated and null ids, ids beyond 2 ** 53, and one text in two sources."""
    base = "the words of a text that has several sentences and tells a story of the sea"
    other = "quite another text about mountains and rivers and the people who live by them now"
    big = 9007199254740993
    rows = [
        (0, base, "en", "a", 1),
        (1, base + " again", "en", "a", 1),
        (1, other, "en", "a", 1),
        (5, other + " indeed", "en", "b", 1),
        (6, "nothing like the others is in here, only these few words of its own", "en", "b", 1),
        (big, "an id that no double can hold stands beside this one text", "en", "a", 1),
        (None, "a text that has come without any id at all, as some texts do", "en", "c", 1),
        (None, "a text that has come without any id at all, as some texts do", "en", "c", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    near = stage("near_copies")(spark, docs, SMALL)
    kept = [r.asDict() for r in near.collect()]
    check([("near_copies", [r.asDict() for r in docs.collect()], kept)])
    texts = [r["text"] for r in kept]
    assert any(t.startswith(other) for t in texts) and any(t.startswith(base) for t in texts)
    assert len(kept) == 5

    same = "one text stands in two sources under one id, and belongs to both of them"
    twice = [(7, same, "en", "a", 1), (7, same, "de", "b", 1), (big, base, "en", "a", 1), (None, other, "en", "b", 1)]
    docs = spark.createDataFrame(twice, SCHEMA).selectExpr("*", "'x' AS _parts", "'y' AS _id", "1 AS _hash")
    from precinct.llm.mixing import mix, mixed_documents, words_taken

    known, taken = mix(docs, block_words=4)
    mixed = mixed_documents(docs, known, taken, block_words=4)
    assert {"_parts", "_id", "_hash", "shard", "slot"} <= set(mixed.columns)
    found = mixed.collect()
    assert {(r["doc_id"], r["source"], r["lang"]) for r in found} == {(i, s, k) for i, _, k, s, _ in twice}
    counted = sum(r["taken"] for r in words_taken(known, taken, block_words=4).collect())
    assert counted == sum(len(words(r["text"])) for r in found)
