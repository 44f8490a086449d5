"""Byte-level BPE: vectorised pre-tokenisation, cached merging, decoding by offsets.

Texts are arrays of code points, mapped to classes. A finite automaton over the classes finds
where the pieces of the pre-tokenisation begin. Each class is a function from state to state;
functions compose associatively, so states are found by a blocked scan over compositions
instead of a loop over characters. Pieces are slices of the UTF-8 bytes; equal slices are
merged once, and their ids are kept in a cache. Token ends, in bytes, are kept as well;
decoding looks up each id's bytes and joins them.

Null texts are empty texts and have no tokens; repeated rows are encoded one by one; texts of
any length are processed in pieces that begin where a token begins; an empty table gives an
empty result; columns of the input other than the id and the text are not used.
"""

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from precinct.llm.common import importable, worker_table

# Characters encoded together, and entries in the cache of merged pieces.
CHUNK = 1 << 20
CACHE = 150_000

# Classes of characters. White space and apostrophes are classed with what follows them.
LETTER, NUMBER, OTHER = 0, 1, 2
SHORT_TAIL, LONG_TAIL = 3, 4  # an apostrophe before s t m d, or before re ve ll
LAST_SPACE, LAST_BLANK, BLANK, BREAK = 5, 6, 7, 8
CLASSES = 9

# States: what the piece is that the last character belongs to.
DONE, SPACE, LETTERS, NUMBERS, OTHERS, BLANKS, ONE_MORE, TWO_MORE = range(8)
STATES = 8

# The property White_Space of Unicode.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
WHITE += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins with this character."""
    if state == TWO_MORE and kind == LETTER:
        return ONE_MORE, False
    if state == ONE_MORE and kind == LETTER:
        return DONE, False
    if kind == LETTER:
        return LETTERS, state not in (SPACE, LETTERS)
    if kind == NUMBER:
        return NUMBERS, state not in (SPACE, NUMBERS)
    if kind in (OTHER, SHORT_TAIL, LONG_TAIL):
        if state in (SPACE, OTHERS):
            return OTHERS, False
        return {OTHER: OTHERS, SHORT_TAIL: ONE_MORE, LONG_TAIL: TWO_MORE}[kind], True
    if kind == LAST_SPACE:
        return SPACE, True
    if kind == BLANK:
        return BLANKS, state != BLANKS
    return DONE, True


@lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tables: next state and begin by state and class; composition and effect by function.

    Functions are numbered, those of single classes first.
    """
    following = np.array([[step(s, k)[0] for k in range(CLASSES)] for s in range(STATES)])
    begins = np.array([[step(s, k)[1] for k in range(CLASSES)] for s in range(STATES)])
    functions = [tuple(following[:, k]) for k in range(CLASSES)]
    number = {f: i for i, f in reversed(list(enumerate(functions)))}
    at = 0
    while at < len(functions):
        for k in range(CLASSES):
            both = tuple(int(following[s, k]) for s in functions[at])
            if both not in number:
                number[both] = len(functions)
                functions.append(both)
        at += 1
    composed = [[number[tuple(g[s] for s in f)] for g in functions] for f in functions]
    return (
        following.astype(np.uint8).ravel(),
        begins.ravel(),
        np.array(composed, dtype=np.uint16),
        np.array(functions, dtype=np.uint8),
    )


def states_before(functions: np.ndarray, width: int = 64) -> np.ndarray:
    """The state before each function, when they are applied in turn to DONE."""
    _, _, composed, effect = automaton()
    n = len(functions)
    if n <= width:
        states, state = np.empty(n, np.uint8), DONE
        for i, f in enumerate(functions.tolist()):
            states[i] = state
            state = effect[f, state]
        return states
    rows = -(-n // width)
    padded = np.zeros(rows * width, functions.dtype)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(rows, width).T)
    table, size = composed.ravel(), np.uint32(len(composed))
    whole = columns[0].astype(np.uint32)
    for column in columns[1:]:
        whole = table[whole * size + column].astype(np.uint32)
    state = states_before(whole.astype(np.uint16))
    out = np.empty((width, rows), np.uint8)
    applied = effect.ravel()
    for i, column in enumerate(columns):
        out[i] = state
        state = applied[column.astype(np.uint32) * np.uint32(STATES) + state]
    return np.ascontiguousarray(out.T).ravel()[:n]


@lru_cache(1)
def class_table() -> np.ndarray:
    """The class of each code point, without regard to what follows."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        group = unicodedata.category(chr(code))[0]
        if group in "LN":
            table[code] = LETTER if group == "L" else NUMBER
    table[WHITE] = BLANK
    return table


def classes(codes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """The class of each character; ``breaks`` are places between texts."""
    kinds = class_table()[codes]
    kinds[breaks] = BREAK
    blank = kinds == BLANK
    followed = np.empty(len(kinds), bool)
    followed[-1] = False
    followed[:-1] = kinds[1:] < BLANK  # by a character that is neither blank nor a break
    last = np.flatnonzero(blank & followed)
    kinds[last] = np.where(codes[last] == 32, LAST_SPACE, LAST_BLANK)
    marks = np.flatnonzero(codes == 39)
    if len(marks):
        ahead = np.concatenate([codes, np.zeros(2, codes.dtype)])
        one, two = ahead[marks + 1], ahead[marks + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pairs = ("re", "ve", "ll")
        long = np.zeros(len(marks), bool)
        for first, second in pairs:
            long |= (one == ord(first)) & (two == ord(second))
        kinds[marks[short]] = SHORT_TAIL
        kinds[marks[long]] = LONG_TAIL
    return kinds


def piece_starts(codes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Indexes of the characters with which pieces begin; breaks are pieces too."""
    _, begins, _, _ = automaton()
    kinds = classes(codes, breaks)
    state = states_before(kinds)
    return np.flatnonzero(begins[state.astype(np.uint16) * np.uint16(CLASSES) + kinds])


class Pairs:
    """Which token two adjacent tokens make: a hash table in arrays, probed for many at once."""

    FREE = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, left: np.ndarray, right: np.ndarray, token: np.ndarray, none: int) -> None:
        self.none = none
        bits = max(4, int(len(token)).bit_length() + 3)
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, self.FREE)
        self.values = np.full(1 << bits, none, np.int32)
        keys = self.key(left, right)
        slots, todo = self.home(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slots[todo]] == self.FREE]
            self.keys[slots[free]] = keys[free]
            own = todo[self.keys[slots[todo]] == keys[todo]]
            self.values[slots[own]] = token[own]
            todo = todo[self.keys[slots[todo]] != keys[todo]]
            slots[todo] = (slots[todo] + np.uint64(1)) & self.mask

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self.key(left, right)
        slots = self.home(keys)
        out = self.values[slots]
        held = self.keys[slots]
        todo = np.flatnonzero((held != keys) & (held != self.FREE))
        out[held != keys] = self.none
        while len(todo):
            slots[todo] = (slots[todo] + np.uint64(1)) & self.mask
            held = self.keys[slots[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[slots[todo[hit]]]
            todo = todo[~hit & (held != self.FREE)]
        return out


class Vocabulary:
    """Ranks of a vocabulary, the merges they stand for, and each id's bytes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.cache: dict[bytes, tuple[int, ...]] = {}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.none = len(tokens)
        self.octets = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        made = [
            (ranks[token[:cut]], ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        self.pairs = Pairs(*np.array(made, dtype=np.int32).reshape(-1, 3).T, self.none)

    def merge_many(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Merges pieces of up to ``width`` bytes side by side, one merge of each at a time."""
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        data = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8)
        ids = self.octets[data].reshape(n, width)
        places = np.arange(width)
        made = np.full((n, width), self.none, np.int32)
        made[:, :-1] = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, -1)
        made[places >= (sizes - 1)[:, None]] = self.none
        out, rows = ids.copy(), np.arange(n)
        left = sizes.copy()
        while len(rows):
            at = made.argmin(1)
            each = np.arange(len(rows))
            token = made[each, at]
            going = token < self.none
            if not going.all():
                over = ~going
                out[rows[over]] = ids[over]
                ids, made, rows = ids[going], made[going], rows[going]
                at, token, each = at[going], token[going], np.arange(len(ids))
                if not len(rows):
                    break
            left[rows] -= 1
            # Everything behind the merged pair moves one place to the front.
            move = np.minimum(places + (places > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, move, 1)
            ids[each, at] = token
            made = np.take_along_axis(made, np.minimum(places + (places >= at[:, None]), width - 1), 1)
            now = left[rows]
            right = np.flatnonzero(at + 1 < now)
            made[each, at] = self.none
            made[right, at[right]] = self.pairs.find(token[right], ids[right, at[right] + 1])
            before = np.flatnonzero(at > 0)
            made[before, at[before] - 1] = self.pairs.find(ids[before, at[before] - 1], token[before])
        return [tuple(row[:k]) for row, k in zip(out.tolist(), left.tolist())]

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a piece of any length, by a heap of pairs.

        The pair that makes the token with the lowest rank is merged first, the left of
        equals.
        """
        n = len(piece)
        end, before, after = [i + 1 for i in range(n)], list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank = self.ranks.get(piece[i : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[i], end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            j = after[i] if end[i] == middle else n
            if j >= n or end[j] != stop or before[j] != i:
                continue
            end[i], end[j], after[i] = stop, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = after[i]
        return tuple(out)

    def ids_of(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of distinct pieces; those that are not in the cache are merged together."""
        cache, ranks = self.cache, self.ranks
        if len(cache) > CACHE:
            cache.clear()
        new: dict[int, list[bytes]] = {8: [], 16: [], 32: []}
        for piece in pieces:
            if piece not in cache:
                whole = ranks.get(piece)
                if whole is not None:
                    cache[piece] = (whole,)
                elif len(piece) <= 32:
                    new[8 if len(piece) <= 8 else 16 if len(piece) <= 16 else 32].append(piece)
                else:
                    cache[piece] = self.merge_long(piece)
        for width, some in new.items():
            if some:
                cache.update(zip(some, self.merge_many(some, width)))
        return [cache[piece] for piece in pieces]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and where each text's ids end."""
        joined = "\0".join(texts) + "\0"
        data = joined.encode("utf-8", "surrogatepass")
        octets = np.frombuffer(data, dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        breaks = np.cumsum(lengths + 1) - 1
        if len(octets) == len(joined):
            codes, at_byte = octets, None
        else:
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            heads = np.flatnonzero((octets & 0xC0) != 0x80)
            at_byte = heads
        starts = piece_starts(codes, breaks)
        where = starts if at_byte is None else at_byte[starts]
        stops = np.append(where[1:], len(octets))
        is_break = np.zeros(len(codes), bool)
        is_break[breaks] = True
        counts, flat, pick = self.slices(data, octets, where, stops, is_break[starts])
        total = np.cumsum(counts[pick])
        n = counts[pick]
        first = np.cumsum(counts) - counts
        source = np.repeat(first[pick] - (total - n), n) + np.arange(total[-1])
        ends = total[np.flatnonzero(is_break[starts])]
        return flat[source], ends

    def slices(self, data, octets, where, stops, is_break):
        """Merges distinct slices: ids by distinct slice, flat, and each slice's number.

        Slices of up to 16 bytes are compared as two integers; a hash only sorts them, and
        those that differ from the first of their hash are looked up one by one, like
        longer ones.
        """
        size = stops - where
        padded = np.concatenate([octets, np.zeros(16, np.uint8)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
        left = np.clip(size, 0, 8)
        right = np.clip(size - 8, 0, 8)
        masks = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)
        low = windows[where].view("<u8").ravel() & masks[left]
        high = windows[np.minimum(where + 8, len(octets))].view("<u8").ravel() & masks[right]
        mixed = (low ^ (low >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= (high ^ (high >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= size.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
        _, first, pick = np.unique(mixed, return_index=True, return_inverse=True)
        rep = first[pick]
        same = (low[rep] == low) & (high[rep] == high) & (size[rep] == size) & (size <= 16)
        same &= is_break[rep] == is_break
        odd = np.flatnonzero(~same)
        chosen = np.concatenate([first, odd])
        pick[odd] = len(first) + np.arange(len(odd))
        begin, end = where[chosen].tolist(), stops[chosen].tolist()
        drop = is_break[chosen].tolist()
        found = self.ids_of([data[b:e] for b, e in zip(begin, end)])
        found = [() if d else ids for d, ids in zip(drop, found)]
        counts = np.fromiter((len(x) for x in found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum()))
        return counts, flat, pick

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, joined, and where each id's bytes end."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return np.empty(0, np.uint8), ends
        source = np.repeat(self.offsets[ids] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.flat[source], ends


def read_ranks(path: str) -> bytes:
    """A rank file: a line for each token, with its bytes in base 64 and its rank."""
    with open(path, "rb") as file:
        return file.read()


def vocabulary(ranks: bytes) -> Vocabulary:
    def build() -> Vocabulary:
        pairs = (line.split() for line in ranks.splitlines() if line)
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in pairs})

    return worker_table(("vocabulary", ranks), build)


def cuts(text: str, most: int) -> Iterator[str]:
    """``text`` in parts of about ``most`` characters, each of which begins a piece.

    A space before a character that is not white space always begins a piece. Where there
    is none, the part is longer.
    """
    begin = 0
    while len(text) - begin > most:
        at = text.find(" ", begin + most)
        while at >= 0 and (at + 1 == len(text) or ord(text[at + 1]) in _WHITE):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[begin:at]
        begin = at
    yield text[begin:]


_WHITE = frozenset(WHITE)


def chunks(texts: list[str], most: int = CHUNK) -> Iterator[tuple[list[int], list[str]]]:
    """Parts of texts that together have about ``most`` characters, with their text's index."""
    owners, parts, held = [], [], 0
    for i, text in enumerate(texts):
        for part in cuts(text, most):
            if held and held + len(part) > most:
                yield owners, parts
                owners, parts, held = [], [], 0
            owners.append(i)
            parts.append(part)
            held += len(part) + 1
    if parts:
        yield owners, parts


def encoded(words: Vocabulary, texts: list[str], keep: bool) -> dict[str, list]:
    """Columns of the result for the given texts, in order."""
    n = len(texts)
    tokens = [0] * n
    of_ids, of_bytes = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
    ids: list[list[np.ndarray]] = [[] for _ in texts]
    for owners, parts in chunks(texts):
        flat, ends = words.encode(parts)
        flat = flat.astype("<u4")
        data, token_ends = words.decode(flat)
        begin = 0
        for owner, end in zip(owners, ends.tolist()):
            own = flat[begin:end]
            if end > begin:
                head = token_ends[begin - 1] if begin else 0
                of_ids[owner].update(own)
                of_bytes[owner].update(data[head : token_ends[end - 1]])
                tokens[owner] += end - begin
                if keep:
                    ids[owner].append(own.astype(np.int32))
            begin = end
    out = {
        "n_tokens": pa.array(tokens, pa.int64()),
        "ids_sha256": pa.array([h.hexdigest() for h in of_ids]),
        "decoded_sha256": pa.array([h.hexdigest() for h in of_bytes]),
    }
    if keep:
        sizes = np.cumsum([0, *(sum(map(len, own)) for own in ids)])
        arrays = [a for own in ids for a in own]
        values = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
        out["ids"] = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values))
    return out


def encode_documents(
    docs: DataFrame,
    rank_file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """``doc_id n_tokens ids_sha256 decoded_sha256`` and, if wished, ``ids`` of every text.

    The digests are those of the ids as little-endian 32-bit integers and of the bytes that
    the ids decode to. The rank file is read on the driver and broadcast; its size is fixed.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_file))
    kept = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = ["" if t is None else t for t in part.column(1).to_pylist()]
                columns = {"doc_id": part.column(0)} | encoded(words, texts, keep_ids)
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, "
    schema += "ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return importable(kept).mapInArrow(run, schema)
