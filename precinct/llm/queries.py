"""The registered queries of this subpackage and the SQL they must equal."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm import compression_quality, language_id, licenses
from precinct.llm.byte_bpe import encode_documents
from precinct.llm.common import held_out, table
from precinct.llm.decontamination import passages
from precinct.llm.hard_negatives import hard_negatives
from precinct.llm.lexical_search import search
from precinct.llm.mixing import mix, words_taken
from precinct.llm.near_join import near_components
from precinct.llm.pseudonyms import pseudonymise
from precinct.llm.quality_rules import BASE, STOP_WORDS, TABLE, quality_rules
from precinct.llm.sharding import shard_documents
from precinct.llm.top_k import top_k

# The tokenizer that production data is encoded with.
TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

# In production the key comes from a store of secrets; with this one, results can be compared.
KEY = b"pseudonyms of the registered query"

Query = Callable[[SparkSession, str], DataFrame]


def op9_metric_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the size of its shingle set and its component of similar ones."""
    return near_components(table(spark, folder, "documents"), words=4, percent=85)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its counts and whether the rules keep it."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = quality_rules(table(spark, folder, "documents"))
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op1_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every text with pseudonyms for personal data and secrets, and the kinds found."""
    hidden = pseudonymise(table(spark, folder, "documents"), KEY)
    kinds = F.array_join(F.array_sort(F.map_keys("replaced")), ",")
    return hidden.select("doc_id", "text", "n_replaced", kinds.alias("kinds"))


def op2_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every text, learnt from labels that are not held out."""
    docs, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    model = compression_quality.fit(docs, labels, ~held_out("doc_id", 5, 0))
    scored = compression_quality.score(docs, model)
    return scored.select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op3_best_fit_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard of 16, with nearly equal bytes."""
    sharded = shard_documents(table(spark, folder, "documents"), shards=16)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_cross_parsing(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text, learnt from documents that are not held out."""
    docs = table(spark, folder, "documents")
    samples = language_id.fit(docs, ~held_out("doc_id", 3, 1))
    judged = language_id.predict(docs.select("doc_id", "text"), samples)
    return judged.select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score"
    )


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The licence notices of every document."""
    docs = table(spark, folder, "documents")
    return licenses.licenses(docs, licenses.scan(docs, licenses.fit(docs)))


def op6_mix_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The words that the mix takes of every document."""
    return words_taken(*mix(table(spark, folder, "documents")))


def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five best products of every fiftieth vector."""
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5, scale=256)


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every text's token ids, and of the bytes they decode to."""
    return encode_documents(table(spark, folder, "documents"), TOKENIZER, keep_ids=False)


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after the labels of every seventh are moved on."""
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """For every document, its words inside benchmark passages and the items found."""
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return passages(docs, items, width=10).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Query] = {
    "op1_pseudonyms": op1_pseudonyms,
    "op2_compression_quality": op2_compression_quality,
    "op3_best_fit_shards": op3_best_fit_shards,
    "op4_cross_parsing": op4_cross_parsing,
    "op5_license_scan": op5_license_scan,
    "op6_mix_blocks": op6_mix_blocks,
    "op7_top_k": op7_top_k,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_metric_join": op9_metric_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical_search": op12_lexical_search,
    "op13_decontamination": op13_decontamination,
}

_STOPS = sorted({w for listed in STOP_WORDS.values() for w in listed.split()})

# Terms of a text in SQL: A-Z lower-cased, then runs of digits, letters and beyond ASCII.
_TERMS = r"""regexp_extract_all(translate(coalesce("text", ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE: dict[str, str] = {
    "op7_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
    FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s)
WHERE r <= 5
""",
    "op10_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce("text", '') AS t FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM d),
win AS (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
    FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT r, i FROM
    (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM win) WHERE n >= 2),
covered AS (SELECT r, count(DISTINCT i + k) AS n
    FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    len(ls) AS n_lines,
    len(list_filter(ws, lambda x: list_contains({_STOPS!r}, x))) AS n_stops
    FROM d JOIN w USING (r) LEFT JOIN covered USING (r)),
j AS (SELECT *, n_words < {BASE[0].least} OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed
    AND word_chars / n_words BETWEEN {TABLE[0].least} AND {TABLE[0].most}
    AND n_symbols / n_words <= {TABLE[1].most}
    AND n_stops / n_words >= {TABLE[2].least}
    AND CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END <= {TABLE[3].most} AS kept
FROM j
""",
    "op11_hard_negatives": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, v.r AS other, v.vec_id, a.label = v.label AS alike,
    CAST(list_sum(list_transform(list_zip(a.c, v.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v AS a JOIN v ON a.r <> v.r WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other) AS place
    FROM s WHERE alike) WHERE place <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id,
    s.score AS negative_score,
    row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id, s.other) AS i
    FROM p JOIN s ON p.r = s.r AND NOT s.alike
    AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score)
SELECT anchor_id, positive_id, CAST(i AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE i <= 10
""",
    "op12_lexical_search": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
c AS (SELECT r, doc_id, len(ts) AS n, ts FROM d WHERE len(ts) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM c),
f AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM c) GROUP BY r, t),
i AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark)),
w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT t, count(*) AS df FROM f GROUP BY t), total),
s AS (SELECT item_id, c.r, c.doc_id, CAST(sum(w.w * ((1000000000 * f.tf)
    // (1000 * f.tf + 8 * (10 + (90 * c.n * total.docs) // total.terms)))) AS BIGINT) AS score
    FROM i JOIN f USING (t) JOIN w USING (t) JOIN c USING (r), total GROUP BY item_id, c.r, c.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS i FROM s WHERE score > 0)
SELECT item_id, CAST(i AS INTEGER) AS rank, doc_id, score FROM k WHERE i <= 10
""",
    "op13_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ws FROM documents),
i AS (SELECT item_id, ws, least(10, len(ws)) AS size
    FROM (SELECT item_id, {_TERMS} AS ws FROM benchmark) WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(ws[b:b + size - 1], ' ') AS w
    FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS b FROM i)),
spot AS (SELECT r, b, size, array_to_string(ws[b:b + size - 1], ' ') AS w
    FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS b
        FROM d JOIN (SELECT DISTINCT size FROM i) ON len(ws) >= size)),
o AS (SELECT r, b, spot.size, item_id FROM spot JOIN win ON spot.size = win.size AND spot.w = win.w),
h AS (SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT r, unnest(range(b, b + size)) AS p FROM o) GROUP BY r),
f AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM o GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
    sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN f USING (r)
""",
}
