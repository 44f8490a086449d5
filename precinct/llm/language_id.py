"""Language identification by cross-parsing entropy.

Labelled text of each language becomes a suffix automaton. A text is parsed greedily against
each: a phrase is the longest match with the labelled text that starts where the last phrase
ended. Text in a language falls into few long phrases against that language's automaton; the
language that needs the fewest phrases per character, weighted with the bits that name a
phrase, wins.

Texts are cut into segments, which are parsed side by side as lanes of arrays: one step moves
all segments by a character in all automata. A segment's first phrase starts afresh.
"""

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import importable, window, worker_table

UNDETERMINED = "und"
# Labelled text: so many passages for each language, each of so many characters.
PASSAGES = 128
PASSAGE_CHARS = 256
# Languages a model may have; their labelled text is collected on the driver.
MOST_LANGUAGES = 256
# Letters an automaton tells apart; rarer ones count as one.
SYMBOLS = 96
SEGMENT = 512
CHUNK = 1 << 20
# How fast the score falls as a second language comes close.
SHARPNESS = 12.0

SPACE, RARE, FIRST_LETTER = 0, 1, 2
RESTART = np.uint32(1 << 31)


@lru_cache(1)
def folded() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is none."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        if unicodedata.category(chr(code))[0] == "L":
            lower = chr(code).lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def spaced(letters: np.ndarray) -> np.ndarray:
    """Letters with one 0 between words: runs of anything else become one."""
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    return keep


class SuffixAutomaton:
    """The least automaton that accepts all substrings of a sequence of small integers."""

    def __init__(self, symbols: list[int]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for symbol in symbols:
            last = self.extend(last, symbol)

    def state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def extend(self, last: int, symbol: int) -> int:
        new = self.state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at < 0:
            return new
        target = self.next[at][symbol]
        if self.length[target] == self.length[at] + 1:
            self.link[new] = target
            return new
        copy = self.state(self.length[at] + 1, dict(self.next[target]), self.link[target])
        while at >= 0 and self.next[at].get(symbol) == target:
            self.next[at][symbol] = copy
            at = self.link[at]
        self.link[target] = self.link[new] = copy
        return new


class Model:
    """Automata of all languages in one table of transitions."""

    def __init__(self, samples: tuple[tuple[str, str], ...]) -> None:
        self.languages = [language for language, _ in samples]
        letters = [folded()[code_points(text)] for _, text in samples]
        letters = [x[spaced(x)] for x in letters]
        joined = np.concatenate([*letters, np.empty(0, np.uint32)])
        codes, counts = np.unique(joined[joined > 0], return_counts=True)
        common = codes[np.argsort(-counts, kind="stable")][: SYMBOLS - FIRST_LETTER]
        self.symbol = np.full(0x110000, RARE, np.uint8)
        self.symbol[0] = SPACE
        self.symbol[common] = FIRST_LETTER + np.arange(len(common))
        self.width = FIRST_LETTER + len(common)
        tables, self.roots, self.bits, base = [], [], [], 0
        for own in letters:
            automaton = SuffixAutomaton(self.symbol[own].tolist())
            # One state more: behind a letter that the sample has not, all begins anew.
            states = len(automaton.next) + 1
            table = np.full((states, self.width), RESTART, np.uint32)
            for state, following in enumerate(automaton.next):
                for symbol, target in following.items():
                    table[state, symbol] = target
            missing = table == RESTART
            first = np.where(table[0] == RESTART, states - 1, table[0])
            table = np.where(missing, first[None, :], table) + np.uint32(base)
            # States are kept as offsets of their row in the joined table.
            tables.append(table * np.uint32(self.width) | np.where(missing, RESTART, np.uint32(0)))
            self.roots.append(base * self.width)
            self.bits.append(np.log2(max(2, len(own))))
            base += states
        # Put together one by one, so that no table is held twice.
        self.table = np.empty(base * self.width, np.uint32)
        end = len(self.table)
        while tables:
            own = tables.pop().ravel()
            self.table[end - len(own) : end] = own
            end -= len(own)

    def phrases(self, lanes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each lane (a column of symbols) by language; longest lanes first."""
        steps = lanes.shape[0]
        active = np.searchsorted(-lengths, -np.arange(steps), side="left")
        roots = np.array(self.roots, np.uint32)[:, None]
        state = np.repeat(roots, lanes.shape[1], axis=1)
        found = np.zeros(state.shape, np.uint32)
        for step in range(steps):
            k = active[step]
            moved = self.table[state[:, :k] + lanes[step, :k]]
            found[:, :k] += moved >> np.uint32(31)
            state[:, :k] = moved & ~RESTART
        return found + np.uint32(1)

    def rates(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text by language, and each text's letters."""
        joined = code_points("\0".join(texts) + "\0")
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        letters = folded()[joined]
        # The character behind each text is none of a word, so texts stay apart.
        keep = spaced(letters)
        owner = np.repeat(np.arange(len(texts)), sizes)[keep]
        letters = letters[keep]
        symbols = self.symbol[letters]
        has = np.bincount(owner, letters > 0, len(texts))
        count = np.bincount(owner, minlength=len(texts))
        start = np.cumsum(count) - count
        segments = -(-count // SEGMENT)
        lane_owner = np.repeat(np.arange(len(texts)), segments)
        place = np.arange(len(lane_owner)) - np.repeat(np.cumsum(segments) - segments, segments)
        begin = start[lane_owner] + place * SEGMENT
        length = np.minimum(count[lane_owner] - place * SEGMENT, SEGMENT)
        order = np.argsort(-length, kind="stable")
        begin, length, lane_owner = begin[order], length[order], lane_owner[order]
        padded = np.concatenate([symbols, np.zeros(SEGMENT, np.uint8)])
        lanes = np.ascontiguousarray(
            np.lib.stride_tricks.sliding_window_view(padded, SEGMENT)[begin].T
        )
        found = self.phrases(lanes[: length[0] if len(length) else 0], length)
        out = np.empty((len(self.languages), len(texts)))
        for i, bits in enumerate(self.bits):
            total = np.bincount(lane_owner, found[i], len(texts))
            out[i] = bits * total / np.maximum(count, 1)
        return out, has

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rates, letters = self.rates(texts)
        best = rates.argmin(0)
        least = rates[best, np.arange(len(texts))]
        near = np.exp(-SHARPNESS * (rates - least) / np.maximum(least, 1e-9))
        score = np.where(letters > 0, 1.0 / near.sum(0), 0.0)
        names = [
            self.languages[b] if some else UNDETERMINED for b, some in zip(best, letters > 0)
        ]
        return names, score


def model_of(samples: tuple[tuple[str, str], ...]) -> Model:
    return worker_table(("language", samples), lambda: Model(samples))


def fit(
    docs: DataFrame,
    usable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> tuple[tuple[str, str], ...]:
    """Labelled text by language, from rows with ``usable``, a language and a text.

    Rows, and the place of the passage in each text, are chosen by hashes of the id. At most
    about ``PASSAGES`` passages of ``PASSAGE_CHARS`` characters a language are collected,
    whatever the size of the input.
    """
    known = docs.filter(usable & docs[lang].isNotNull() & (F.octet_length(docs[text]) > 0))
    known = known.select(
        docs[doc_id].alias("doc_id"), docs[lang].alias("lang"), docs[text].alias("text")
    )
    counts = known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return ()
    spark = docs.sparkSession
    share = spark.createDataFrame(
        [(r["lang"], min(1.0, 1.25 * PASSAGES / r["count"])) for r in counts],
        "lang string, share double",
    )
    # A number in [0, 1) for each row, the same in every run.
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    chosen = (
        known.join(F.broadcast(share), "lang")
        .filter(draw < F.col("share"))
        .select("lang", "doc_id", window("text", PASSAGE_CHARS, "doc_id").alias("text"))
        .collect()
    )
    passages: dict[str, list[str]] = {}
    for row in sorted(chosen, key=lambda r: (r["lang"], r["doc_id"] or 0, r["text"])):
        own = passages.setdefault(row["lang"], [])
        if len(own) < PASSAGES:
            own.append(row["text"])
    return tuple((language, "\n".join(own)) for language, own in passages.items())


def predict(
    docs: DataFrame, samples: tuple[tuple[str, str], ...], text: str = "text"
) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to all rows; columns of that name are replaced.

    A null text and a text without a letter are ``und`` with score 0, as is every text if
    there was no labelled text. Equal rates go to the first language by name. The ``SYMBOLS``
    letters that labelled texts have most are told apart; all others count as one letter, so
    languages of very many letters are told apart by their frequent ones only. Rows are judged one by one;
    an empty table gives an empty result. The score is 1 where no other language comes near.
    """
    kept = docs.drop("lang_pred", "score")
    names_in = kept.columns
    place = names_in.index(text)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(samples)
        for batch in batches:
            for part in runs(batch, place):
                texts = [t or "" for t in part.column(place).to_pylist()]
                names, score = model.predict(texts)
                columns = [*part.columns, pa.array(names, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, [*names_in, "lang_pred", "score"])

    schema = ", ".join([*fields, "lang_pred string", "score double"])
    return importable(kept).mapInArrow(run, schema)


def runs(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch that together have about ``CHUNK`` bytes of text; a row stays whole."""
    sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0)
    begin = held = 0
    for row, size in enumerate(sizes.to_pylist()):
        if row > begin and held + size > CHUNK:
            yield batch.slice(begin, row - begin)
            begin = row
            held = 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)
