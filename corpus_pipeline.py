"""The corpus pipeline: from raw documents to encoded training rows.

Each stage is a function of (spark, docs, sf_dir) and gives a DataFrame. Stages are written as
Parquet and read again, so that each one begins with a table of known size and an executor
that is lost costs its own tasks only. All but the last keep the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm import language_id
from precinct.llm.byte_bpe import encode_documents
from precinct.llm.common import held_out, table
from precinct.llm.mixing import mix, mixed_documents
from precinct.llm.near_join import without_near_copies
from precinct.llm.pseudonyms import pseudonymise
from precinct.plans.scratch import stored

# The session's setting that holds the key of the pseudonyms; without it, as in tests, a fixed one.
KEY_SETTING = "spark.precinct.pseudonyms.key"
KEY = b"pseudonyms of the corpus pipeline"
TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language the labelled ones teach; their ``lang`` is the found one.

    Rejected are documents without a letter, which are in no language.
    """
    samples = language_id.fit(docs, ~held_out("doc_id", 3, 1))
    judged = language_id.predict(docs, samples)
    kept = judged.filter(F.col("lang_pred") != language_id.UNDETERMINED)
    return kept.withColumn("lang", F.col("lang_pred")).select(COLUMNS)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id.

    Documents are near copies if they share 80 % of their five-word shingles or more. Rows
    with a null or repeated id are documents like others: of equal ones, one stays, and an id
    that two different texts have is no link between them.
    """
    return without_near_copies(docs.select(COLUMNS), words=5, percent=80)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data; ``n_chars`` follows the text."""
    key = spark.conf.get(KEY_SETTING, None)
    hidden = pseudonymise(docs.select(COLUMNS), key.encode() if key else KEY)
    n_chars = F.char_length("text").cast("long")
    return hidden.withColumn("n_chars", n_chars).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each part of a document that lies in a drawn block.

    Blocks are 1,024 words, so parts are whole documents unless a block ends inside one. A
    source above its share loses blocks, one below it has blocks up to three times.
    """
    known, taken = mix(docs, block_words=1_024)
    mixed = mixed_documents(docs.select(COLUMNS), known, taken, block_words=1_024)
    return mixed.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the bytes they decode to.

    Null texts have no tokens; an empty table gives an empty result.
    """
    return encode_documents(docs, TOKENIZER)


STAGES = [
    ("language", identify_language),
    ("near_copies", remove_near_copies),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# Suffix automata, keyed permutations and merges cannot be said in SQL; tests/llm compares
# the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; the last is not stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
