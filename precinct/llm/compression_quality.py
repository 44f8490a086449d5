"""Quality classifier by compression.

One zstandard dictionary is built from text labelled good, one from text labelled bad. A text
is compressed with both; the one that resembles it makes it smaller. The difference of the
two compressed sizes, per byte of text, is turned into a probability by a logistic curve that
is fitted on labelled texts which are not in the dictionaries. (Per byte, not per compressed
byte: text that repeats itself shrinks with any dictionary and must not look good by that.)

Texts are compressed in windows, each on its own, so that every part of a long text is
compared with the dictionaries and not with the text before it. All windows count.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import importable, window

# Labelled texts that are collected for each label, and characters of each.
SAMPLES = 2_000
SAMPLE_CHARS = 2_048
DICTIONARY_BYTES = 112_640
WINDOW = 512
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Dictionaries and the logistic curve over the size difference."""

    good: bytes
    bad: bytes
    slope: float
    offset: float


@lru_cache(4)
def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """Frames without sizes and checksums, so that their length is all payload."""
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if data:
        data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False
    )


def compressed_size(data: bytes, dictionary: bytes) -> int:
    shrink = compressor(dictionary).compress
    return sum(len(shrink(data[i : i + WINDOW])) for i in range(0, len(data), WINDOW))


def difference(data: bytes, good: bytes, bad: bytes) -> float:
    """Bytes that the good dictionary saves against the bad one, per byte; 0 for no text."""
    if not data:
        return 0.0
    return (compressed_size(data, bad) - compressed_size(data, good)) / len(data)


def dictionaries(good: list[str], bad: list[str]) -> list[bytes]:
    """A dictionary for either kind of text, of the strings that help most over all texts.

    Both get the same size, for a larger one would win by size; too few texts give none.
    """
    samples = [[t.encode("utf-8", "surrogatepass") for t in texts] for texts in (good, bad)]
    least = min(sum(map(len, own)) for own in samples)
    if least < 4 * 1024 or min(map(len, samples)) < 8:
        return [b"", b""]
    size = min(DICTIONARY_BYTES, least // 8)
    try:
        return [zstandard.train_dictionary(size, own, level=LEVEL).as_bytes() for own in samples]
    except zstandard.ZstdError:
        return [b"", b""]


def logistic_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a weak pull towards no slope."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], 1)
    pull = np.diag([1e-4, 1e-2])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + pull @ w
        curve = (design * (p * (1 - p))[:, None]).T @ design + pull
        move = np.linalg.solve(curve, slope)
        w -= np.clip(move, -50, 50)
        if np.abs(move).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """Learns from rows of ``labels`` with ``usable`` and a label of 0 or 1.

    About ``SAMPLES`` texts of each label are collected, chosen by a hash of their id,
    whatever the size of the input, and of longer ones ``SAMPLE_CHARS`` characters from a
    place drawn by another hash; two of three go into the dictionaries and the others
    into the curve. Without labels of both kinds, every text scores the share of good ones.
    """
    known = labels.filter(usable & F.col(label).isin(0, 1)).select(
        labels[doc_id].alias("doc_id"), labels[label].cast("int").alias("label")
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    share = F.lit(0.0)
    for value, count in counts.items():
        share = F.when(F.col("label") == value, min(1.0, SAMPLES / count)).otherwise(share)
    # The chosen ids are bounded by SAMPLES, so texts need no shuffle to meet them.
    chosen = known.filter(draw < share).dropDuplicates(["doc_id"])
    rows = (
        docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "label", window("text", SAMPLE_CHARS, "doc_id").alias("text"))
        .filter(F.octet_length("text") > 0)
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    good = sum(r["label"] for r in rows)
    prior = np.log((good + 1) / (len(rows) - good + 1))
    if not good or good == len(rows):
        return Model(b"", b"", 0.0, float(prior))
    fitted = [r for i, r in enumerate(rows) if i % 3]
    books = dictionaries(*([r["text"] for r in fitted if r["label"] == y] for y in (1, 0)))
    rest = rows[::3]
    x = np.array([difference(r["text"].encode("utf-8", "surrogatepass"), *books) for r in rest])
    y = np.array([r["label"] for r in rest], float)
    # Both labels were drawn up to the same number; the curve is for their true shares.
    shift = np.log(counts[1] / counts[0]) - np.log(max(y.sum(), 1) / max((1 - y).sum(), 1))
    slope, offset = logistic_curve(x, y)
    return Model(*books, slope, offset + float(shift))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id score size_difference`` for every text, whole.

    A null text counts as empty; empty texts have difference 0 and the score that the curve
    has there. Rows are scored one by one; an empty table gives an empty result.
    """
    kept = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("binary").alias("data"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                difference(data.as_py() or b"", model.good, model.bad) for data in batch.column(1)
            ]
            x = np.array(found, float)
            p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array(x)],
                ["doc_id", "score", "size_difference"],
            )

    kind = kept.schema["doc_id"].dataType.simpleString()
    return importable(kept).mapInArrow(run, f"doc_id {kind}, score double, size_difference double")
