"""Passages of test items in documents, by multi-pattern search with skips (Wu and Manber).

Patterns are windows of item words, the text is the word sequence of a document, and symbols
are whole words. The search looks at the last words of a possible occurrence, a block. A
shift table tells how far ahead the next occurrence can end, given that block; a block that
no window has skips nearly a whole window. Where the block ends a window, a bucket for that
suffix and the window's first word selects the windows to compare word by word.

Windows of unequal length have tables of their own, so that a short item does not shorten the
skips for all others. Documents stream through the tables in one narrow stage; tables are
built from a broadcast slice of the items of bounded size.
"""

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import importable
from precinct.llm.items import SLICE, Item, Items, term_runs

# Words of a block: two tell far more windows apart than one.
BLOCK = 2

SPANS = "array<struct<begin:bigint,end:bigint>>"
FOUND = f"doc_id bigint, digest bigint, n_words bigint, spans {SPANS}, items array<string>"


class Patterns:
    """Shift table and buckets of all windows of ``size`` words."""

    def __init__(self, size: int, windows: dict[tuple[bytes, ...], set[str]]) -> None:
        self.size, self.block = size, min(BLOCK, size)
        self.shifts: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[bytes, list]] = {}
        for window, items in windows.items():
            for end in range(self.block, size + 1):
                block = window[end - self.block : end]
                self.shifts[block] = min(size - end, self.shifts.get(block, size))
            bucket = self.buckets.setdefault(window[size - self.block :], {})
            bucket.setdefault(window[0], []).append((window, items))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """Begin and items of each occurrence, in order."""
        size, block, shifts, buckets = self.size, self.block, self.shifts, self.buckets
        farthest = size - block + 1
        end, n = size, len(words)
        while end <= n:
            suffix = tuple(words[end - block : end])
            skip = shifts.get(suffix, farthest)
            if skip:
                end += skip
                continue
            begin = end - size
            for window, items in buckets[suffix].get(words[begin], ()):
                if tuple(words[begin:end]) == window:
                    yield begin, items
            end += 1


class Search:
    """All patterns of a slice of items."""

    def __init__(self, items: Iterable[Item], width: int) -> None:
        by_size: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
        for item in items:
            words = [w for run in term_runs(item.data) for w in run]
            size = min(width, len(words))
            for begin in range(len(words) - size + 1 if size else 0):
                window = tuple(words[begin : begin + size])
                by_size.setdefault(size, {}).setdefault(window, set()).add(item.name or "")
        self.patterns = [Patterns(size, windows) for size, windows in sorted(by_size.items())]
        self.longest = max(by_size, default=1)

    def scan(self, data: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, ranges of hit words (apart from each other) and items found."""
        n, spans, found = 0, [], set()
        words: list[bytes] = []
        hit = bytearray()
        for run in term_runs(data):
            words += run
            hit += bytes(len(run))
            n += len(run)
            for patterns in self.patterns:
                for begin, items in patterns.occurrences(words):
                    hit[begin : begin + patterns.size] = b"\1" * patterns.size
                    found |= items
            # The last words may begin an occurrence that ends in the next run.
            done = max(0, len(words) - self.longest + 1)
            ranges(hit[:done], n - len(words), spans)
            words, hit = words[done:], hit[done:]
        ranges(hit, n - len(words), spans)
        return n, spans, sorted(found)


def ranges(hit: bytearray, offset: int, spans: list[tuple[int, int]]) -> None:
    """Appends the runs of ones in ``hit``; one that continues the last range extends it."""
    at = hit.find(1)
    while at >= 0:
        end = hit.find(0, at)
        end = len(hit) if end < 0 else end
        begin = at + offset
        if spans and spans[-1][1] == begin:
            begin = spans.pop()[0]
        spans.append((begin, end + offset))
        at = hit.find(1, end)


def finder(items, width: int, hits_only: bool):
    """Documents ``doc_id digest data`` to FOUND, for the broadcast ``items``."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("digest", pa.int64()),
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            ("items", pa.list_(pa.string())),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items.value, width)
        slices = (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512))
        for rows in slices:
            out = [search.scan(x.as_py() or b"") for x in rows.column(2)]
            columns = [
                rows.column(0),
                rows.column(1),
                pa.array([n for n, _, _ in out], pa.int64()),
                pa.array([[{"begin": b, "end": e} for b, e in s] for _, s, _ in out], schema.types[3]),
                pa.array([found for _, _, found in out], schema.types[4]),
            ]
            made = pa.RecordBatch.from_arrays(columns, schema=schema)
            yield made.filter(pa.array([bool(s) for _, s, _ in out])) if hits_only else made

    return run


def merged(spans: Column) -> Column:
    """Ranges in order, those that touch or overlap as one."""
    empty = F.array().cast(SPANS)

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(
            last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end")
        )
        touches = (F.size(done) > 0) & (span["begin"] <= F.try_element_at(done, F.lit(-1))["end"])
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        return F.when(touches, longer).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, add)


def passages(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most: int = SLICE,
) -> DataFrame:
    """``doc_id n_words spans items`` for every row of ``docs``.

    ``spans`` are the ranges of words that lie in an occurrence of a window, ``[begin, end)``
    counted in words from 0 and apart from each other; ``items`` the ids, as text and in that
    order, of the items that have an occurring window. A window is ``width`` consecutive words
    of an item, or all words of a shorter one.

    Null and blank texts have no words and no spans. Rows with a null or repeated id are rows
    like others. Items with a null id are listed as empty text; items that share an id are
    listed once; items without words are not found. Empty tables give no rows, or rows without
    spans. Other columns are not used. Items beyond ``most`` bytes are searched slice by slice,
    each with a pass over the documents, and what the slices find is merged by document.
    """
    listed = Items(items, item_id, item_text, most)
    data = docs.select(
        docs[doc_id].cast("bigint").alias("doc_id"),
        F.xxhash64(docs[text]).alias("digest"),
        docs[text].cast("binary").alias("data"),
    )

    def found(number: int) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(listed.slice(number))
        return importable(data).mapInArrow(finder(sent, width, number > 0), FOUND)

    whole = found(0)
    if listed.count == 1:
        return whole.drop("digest")
    rest = found(1)
    for number in range(2, listed.count):
        rest = rest.unionByName(found(number))
    # Rows with one id and text have the same passages, so that one of them is enough.
    rest = rest.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_text"), "spans", "items")
    each = rest.groupBy("_id", "_text").agg(
        F.flatten(F.collect_set("spans")).alias("_spans"),
        F.flatten(F.collect_set("items")).alias("_items"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_text"))
    none = F.array()
    return whole.join(each, same, "left").select(
        "doc_id",
        "n_words",
        merged(F.concat("spans", F.coalesce("_spans", none.cast(SPANS)))).alias("spans"),
        F.array_sort(
            F.array_distinct(F.concat("items", F.coalesce("_items", none.cast("array<string>"))))
        ).alias("items"),
    )


def clean(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most: int = SLICE,
) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their columns.

    Rows without words stay; cases are those of ``passages``.
    """
    listed = Items(items, item_id, item_text, most)
    place = docs.columns.index(text)
    for number in range(listed.count):
        sent = docs.sparkSession.sparkContext.broadcast(listed.slice(number))
        docs = importable(docs).mapInArrow(remover(sent, width, place), docs.schema)
    return docs


def remover(items, width: int, place: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items.value, width)
        for batch in batches:
            texts = batch.column(place)
            spans = (search.scan((x.as_py() or "").encode())[1] for x in texts)
            yield batch.filter(pa.array([not s for s in spans], pa.bool_()))

    return run
