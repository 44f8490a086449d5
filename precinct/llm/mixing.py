"""Mixing sources to target weights, by blocks of a fixed number of words.

The words of a source form one sequence, which is cut into blocks of ``block_words``. Output
shards draw how many blocks they take of each source from a multinomial, given what is left
of each source's target. The slots of a source are numbered through all shards; a slot's
number, through a pseudorandom permutation of the source's block indexes that is drawn anew
each time all blocks are used up, names the block. Blocks are joined by index.

Documents have a fixed place in their source's sequence, so the same input gives the same
mix. Null and empty texts hold no words and are taken 0 times; a null source is a source;
repeated rows are documents of their own; an empty table gives an empty mix.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm.common import WORD, free_name, importable, running, word_count
from precinct.llm.common import slices as in_slices
from precinct.plans.scratch import stored

# Most sources: a recipe has a row for each, which the driver reads.
MOST_SOURCES = 100_000
# Output shards: counts per shard and source are drawn on the driver.
MOST_SHARDS = 1_024

# Words of a block: targets are met to about this many words.
BLOCK_WORDS = 128

MASK = np.uint64(0xFFFFFFFF)


def targets(sizes: list[int], weights: list[float], most_repeats: float) -> list[float]:
    """Shares of all words by weight, none above ``most_repeats`` times its source's words.

    What a full source cannot take is shared again by weight among the others.
    """
    total = float(sum(sizes))
    caps = [most_repeats * size for size in sizes]
    full: set[int] = set()
    while True:
        left = total - sum(caps[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        share = {i: left * w / weight for i, w in enumerate(weights) if i not in full}
        above = {i for i, x in share.items() if x > caps[i]}
        if not above:
            return [caps[i] if i in full else share[i] for i in range(len(sizes))]
        full |= above


def whole_blocks(wanted: list[float], sizes: list[int], blocks: list[int], most: float) -> list[int]:
    """Blocks to draw of each source: its target as a share of its words, in blocks, rounded.

    A source at its limit gives each block as often as it may, also its short last one.
    """
    return [
        min(int(most * n), max(int(x * n / size + 0.5), int(x > 0))) if size else 0
        for x, size, n in zip(wanted, sizes, blocks)
    ]


def draws(slots: list[int], shards: int, seed: int) -> list[tuple[int, int, int, int]]:
    """``(shard, source number, first slot, slots)`` for every shard and source drawn.

    Each shard draws a multinomial over what is left of the sources; draws beyond what is
    left of a source go to the sources with most left, so all slots are drawn in the end.
    """
    rng = np.random.Generator(np.random.Philox(seed))
    left = np.array(slots, dtype=np.int64)
    first = np.zeros_like(left)
    out = []
    for shard in range(shards):
        size = -(-int(left.sum()) // (shards - shard))
        if not size:
            continue
        drawn = np.minimum(rng.multinomial(size, left / left.sum()), left)
        for at in np.argsort(drawn - left, kind="stable"):
            lack = size - int(drawn.sum())
            if not lack:
                break
            drawn[at] += min(lack, int(left[at] - drawn[at]))
        out += [(shard, int(i), int(first[i]), int(drawn[i])) for i in np.flatnonzero(drawn)]
        first += drawn
        left -= drawn
    return out


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0 .. size - 1, applied to each index.

    A Feistel network over the next even number of bits; results outside the range go
    through it again until they are inside.
    """
    bits = np.ceil(np.log2(np.maximum(size, 2).astype(np.float64)) / 2).astype(np.uint64)
    low = (np.uint64(1) << bits) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        b, m, k = bits[todo], low[todo], key[todo].astype(np.uint64)
        left, right = out[todo] >> b, out[todo] & m
        for turn in range(4):
            mixed = right + k + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) & 0xFFFFFFFFFFFFFFFF)
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(31))) & m)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def slots_to_blocks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of slots become rows with the block that each slot takes."""
    for part in parts:
        for row in part.itertuples():
            slot = np.arange(row.first, row.first + row.slots)
            turn, place = np.divmod(slot, row.blocks)
            key = np.uint64(row.seed & 0xFFFFFFFFFFFFFFFF) + turn.astype(np.uint64) * MASK
            block = permuted(place, np.full(len(slot), row.blocks), key)
            yield pd.DataFrame(
                {"shard": row.shard, "slot": slot, "source_no": row.source_no, "block": block}
            )


def recipe_of(rows: DataFrame, cycle: tuple[float, ...]) -> list[tuple[int, str, int, float]]:
    """Number, name, words and weight of each source.

    Weights go round by the source's place in code point order, null last.
    """
    found = (
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .limit(MOST_SOURCES + 1)
        .collect()
    )
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: give a coarser column")
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")))
    return [(i, r["source"], r["source_size"], cycle[i % len(cycle)]) for i, r in enumerate(found)]


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (1, 2, 3),
    most_repeats: int = 3,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = 4_096,
    seed: int = 20240201,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The documents with their place and target, and the blocks drawn.

    The first frame has ``doc_id source size first source_no source_size target``, the second
    ``shard slot source_no block``: slot by slot, the block of words ``block * block_words``
    and on of its source. The last block of a source may be short.
    """
    spark: SparkSession = docs.sparkSession
    rows = stored(
        docs.select(
            docs[doc_id].alias("doc_id"),
            docs[source].alias("source"),
            word_count(docs[text]).alias("size"),
            F.xxhash64(docs[text]).alias("text_hash"),
        ),
        "mix-rows",
    )
    recipe = recipe_of(rows, weights)
    sizes = [size for _, _, size, _ in recipe]
    wanted = [0.0] * len(sizes)
    if sum(sizes):
        wanted = targets(sizes, [w for *_, w in recipe], most_repeats)
    blocks = [-(-size // block_words) for size in sizes]
    slots = whole_blocks(wanted, sizes, blocks, most_repeats)
    shards = min(MOST_SHARDS, -(-sum(slots) // shard_blocks))
    drawn = [
        (shard, i, first, n, blocks[i], seed * 1_000_003 + i)
        for shard, i, first, n in draws(slots, shards, seed)
    ]
    sources = spark.createDataFrame(
        [(i, name, size, float(wanted[i])) for i, name, size, _ in recipe],
        "source_no int, named string, source_size bigint, target double",
    )
    runs = spark.createDataFrame(
        drawn, "shard int, source_no int, first bigint, slots bigint, blocks bigint, seed bigint"
    )
    # A run of many slots is divided before it becomes rows; tasks get runs of equal length.
    piece = 65_536
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(piece).cast("long")))
    divided = (
        runs.withColumn("at", starts)
        .withColumn("slots", F.least(F.lit(piece).cast("long"), F.col("slots") - F.col("at")))
        .withColumn("first", F.col("first") + F.col("at"))
        .drop("at")
    )
    schema = "shard int, slot bigint, source_no int, block bigint"
    tasks = max(1, sum(slots) // 250_000)
    spread = importable(divided.repartition(tasks, "shard", "source_no", "first"))
    taken = spread.mapInPandas(slots_to_blocks, schema)
    numbered = rows.join(F.broadcast(sources), rows["source"].eqNullSafe(sources["named"]))
    order = ["doc_id", "text_hash"]
    known = running(
        numbered.drop("named"), ["source_no"], order, {"first": F.col("size")}, rows.count()
    )
    return known, taken


def document_blocks(known: DataFrame, block_words: int) -> DataFrame:
    """A row for each document and block that share words: ``block begin words``.

    ``begin`` is the index, in the document, of the first word that lies in the block.
    """
    last = F.floor((F.col("first") + F.col("size") - 1) / block_words)
    spread = known.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("first") / block_words), last))
    )
    begin = F.greatest(F.col("block") * block_words - F.col("first"), F.lit(0))
    end = F.least((F.col("block") + 1) * block_words - F.col("first"), F.col("size"))
    return spread.withColumns({"begin": begin.cast("long"), "words": (end - begin).cast("long")})


def words_taken(known: DataFrame, taken: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id size source_size target taken``: the words a mix takes of each document."""
    # Sizes are estimated from the few runs that blocks are drawn by: Spark would broadcast.
    times = taken.groupBy("source_no", "block").agg(F.count("*").alias("times")).hint("merge")
    shared = document_blocks(known, block_words).join(times, ["source_no", "block"], "left")
    part = F.col("words") * F.coalesce("times", F.lit(0))
    counted = shared.groupBy("source_no", "first", "doc_id", "size", "source_size", "target").agg(
        F.sum(part).alias("taken")
    )
    # Documents without words share no block; they have no part in the grouping.
    empty = known.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    names = ["doc_id", "size", "source_size", "target", "taken"]
    return counted.select(names).unionByName(empty.select(names))


def cutter(text: int, parts: int):
    """A row for each drawn part of a document, with the part as its text.

    ``text`` and ``parts`` are the places of these columns; all others are taken as they are.
    """
    word = re.compile(WORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows, pieces, shards, slots = [], [], [], []
            for row, (body, drawn) in enumerate(zip(batch.column(text), batch.column(parts))):
                body = body.as_py() or ""
                spans = [m.span() for m in word.finditer(body)]
                for part in drawn.as_py():
                    begin, end = part["begin"], part["begin"] + part["words"]
                    rows.append(row)
                    pieces.append(body[spans[begin][0] : spans[end - 1][1]])
                    shards.append(part["shard"])
                    slots.append(part["slot"])
            index = pa.array(rows, pa.int64())
            columns = {
                name: pa.array(pieces, pa.string()) if at == text else batch.column(at).take(index)
                for at, name in enumerate(batch.schema.names)
                if at != parts
            }
            columns |= {"shard": pa.array(shards, pa.int32()), "slot": pa.array(slots, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def mixed_documents(
    docs: DataFrame,
    known: DataFrame,
    taken: DataFrame,
    block_words: int = BLOCK_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mix itself: columns of ``docs``, and ``shard slot``, for each part of a drawn block.

    The text is the part of the document that lies in the block, with the white space in it
    as it was; the parts with the same shard, slot and source are a block. A row of ``docs``
    that occurs repeatedly gives the parts of all its copies once; rows of different sources
    are never copies. Columns of the input with the names ``shard`` or ``slot`` are replaced.
    """
    drawn = taken.hint("merge").join(document_blocks(known, block_words), ["source_no", "block"])
    keys = ["doc_id", "text_hash", "source"]
    cuts = drawn.groupBy(*keys).agg(
        F.collect_list(F.struct("begin", "words", "shard", "slot")).alias("parts")
    )
    once = docs.drop("shard", "slot")
    own = {name: free_name(once, f"_{name}") for name in ("hash", "parts", "id", "same", "from")}
    once = once.withColumn(own["hash"], F.xxhash64(docs[text]))
    if known.groupBy(*keys).count().filter("count > 1").limit(1).count():
        once = once.dropDuplicates([doc_id, own["hash"], source])
    renamed = cuts.hint("merge").select(
        F.col("doc_id").alias(own["id"]),
        F.col("text_hash").alias(own["same"]),
        F.col("source").alias(own["from"]),
        F.col("parts").alias(own["parts"]),
    )
    same = (
        once[doc_id].eqNullSafe(renamed[own["id"]])
        & (once[own["hash"]] == renamed[own["same"]])
        & once[source].eqNullSafe(renamed[own["from"]])
    )
    joined = once.join(renamed, same).drop(own["id"], own["same"], own["from"], own["hash"])
    schema = joined.drop(own["parts"]).schema.add("shard", "integer").add("slot", "long")
    place = {name: at for at, name in enumerate(joined.columns)}
    return importable(joined).mapInArrow(cutter(place[text], place[own["parts"]]), schema)
