"""Ranked lexical search, reversed: documents stream through an index of the questions.

An inverted index of the items' terms is broadcast: for each term its weight and the items
that hold it. Each document's terms are counted once, those that the index has add their
share to the scores of their items, and each task keeps a bounded heap of the best documents
per item. Heaps are merged in two steps, first in salted parts, then per item.

Statistics come from a first pass with the same terms: the number of documents, the number
of terms, and for each term of an item the documents that hold it. Items beyond a slice of
bounded size are searched slice by slice; slices do not depend on each other.
"""

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import importable
from precinct.llm.items import SLICE, Item, Items, term_runs

# Parts in which the heaps of an item are merged first.
SALTS = 32

DOCUMENTS, TERMS = -1, -2
SCORED = "item_no bigint, doc_id bigint, score bigint"


class Index:
    """Terms of a slice of items, in a fixed order, and the items that hold each."""

    def __init__(self, items: list[Item]) -> None:
        held: dict[bytes, list[int]] = {}
        for place, item in enumerate(items):
            for term in sorted({t for run in term_runs(item.data) for t in run}):
                held.setdefault(term, []).append(place)
        self.numbers = [item.number for item in items]
        self.place = {term: i for i, term in enumerate(held)}
        lists = list(held.values())
        self.lengths = np.array([len(x) for x in lists], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.postings = np.array([x for one in lists for x in one], np.int64)

    def add_up(self, terms: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """The score of each item, from the shares of the terms of a document."""
        lengths, starts = self.lengths[terms], self.starts[terms]
        ends = np.cumsum(lengths)
        spots = np.repeat(starts - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
        scores = np.zeros(len(self.numbers), np.int64)
        np.add.at(scores, self.postings[spots], np.repeat(shares, lengths))
        return scores


def term_counts(data: bytes) -> Counter:
    counts: Counter = Counter()
    for run in term_runs(data):
        counts.update(run)
    return counts


def statistics(items):
    """Sums over a task's documents: how many have a term, all terms, and a term's documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = Index(items.value).place
        held: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts = term_counts(value.as_py() or b"")
                if counts:
                    held[DOCUMENTS] += 1
                    held[TERMS] += counts.total()
                    held.update(place[t] for t in counts.keys() & place.keys())
        columns = [pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "many"])

    return run


def weight(documents: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))


class Best:
    """The ``k`` best documents of each item; among equal scores the smaller id, no id last."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.heaps: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # scores of 0 are none

    def offer(self, doc_id: int | None, scores: np.ndarray) -> None:
        for item in np.flatnonzero(scores >= self.least).tolist():
            heap = self.heaps[item]
            entry = (int(scores[item]), doc_id is not None, -(doc_id or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[item] = heap[0][0]


def ranker(items, weights, documents: int, terms: int, k: int, share: Callable):
    """The best documents of a task, per item."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items.value)
        place, weighed = index.place, weights.value
        best = Best(len(index.numbers), k)
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                counts = term_counts(value.as_py() or b"")
                known = [(place[t], counts[t]) for t in counts.keys() & place.keys()]
                if known:
                    own, often = np.array(known, np.int64).T
                    parts = share(often, counts.total(), documents, terms)
                    best.offer(doc_id.as_py(), index.add_up(own, weighed[own] * parts))
        rows = [
            (number, -negative if has_id else None, score)
            for number, heap in zip(index.numbers, best.heaps)
            for score, has_id, negative in heap
        ]
        columns = [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else ((), (), ()))]
        yield pa.RecordBatch.from_arrays(columns, ["item_no", "doc_id", "score"])

    return run


def saturated(often: np.ndarray, length: int, documents: int, terms: int) -> np.ndarray:
    """A term's share before its weight, in whole numbers: it rises ever less with ``often``,
    and the less the longer the document is beside the mean."""
    m = 100 - 90 + (90 * length * documents) // terms
    return (1_000_000_000 * often) // (1000 * often + 8 * m)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most: int = SLICE,
) -> DataFrame:
    """``item_id rank doc_id score``: the ``k`` best documents of each item with a score above 0.

    Terms are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. A
    term's weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))`` over all documents with a term;
    ``saturated`` has its share by the occurrences. Ranks begin with 1 for the highest score,
    equal scores go by ascending ``doc_id``, null last.

    Null and empty texts have no terms: such documents count nowhere, such items get no rows.
    Rows with a null or repeated id are documents of their own; equal rows of items are one
    item, items that share an id but not the text get rows each. Empty tables give an empty
    result. Other columns are not used. Texts of any length are taken apart in pieces.
    """
    listed = Items(items, item_id, item_text, most)
    data = docs.select(
        docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("binary").alias("data")
    )
    context = docs.sparkSession.sparkContext
    merged = docs.sparkSession.createDataFrame([], SCORED)
    for number in range(listed.count):
        rows = listed.slice(number)
        sent = context.broadcast(rows)
        counted = importable(data.select("data")).mapInArrow(statistics(sent), "term bigint, many bigint")
        # At most as many rows as the slice has terms.
        sums = dict(map(tuple, counted.groupBy("term").agg(F.sum("many")).collect()))
        documents, terms = sums.get(DOCUMENTS, 0), sums.get(TERMS, 0)
        held = [sums.get(i, 0) for i in range(len(Index(rows).place))]
        weights = context.broadcast(np.array([weight(documents, n) for n in held], np.int64))
        found = importable(data).mapInArrow(
            ranker(sent, weights, documents, terms, k, saturated), SCORED
        )
        merged = merged.union(found)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = merged.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    for keys in (["item_no", "_salt"], ["item_no"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        salted = salted.withColumn("rank", place).filter(F.col("rank") <= k)
    return salted.join(listed.names(), "item_no").select("item_id", "rank", "doc_id", "score")
