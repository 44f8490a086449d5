"""Sets of word shingles, and signatures by which similar sets are bound to meet.

Words and shingles are 64-bit hashes, computed for many texts at once. Two different words or
shingles get one hash with a chance of about 2 to the power of -64.

Signatures rest on the pigeonhole principle. Hashes are divided into ranges ("parts"), more of
them than the shingles k in which similar sets can differ, and the hashes of a part make a
signature. Two similar sets differ in at most k parts and agree in all others: a set needs
to share all but k of its filled parts with each set that it is similar to. k follows from
the size of the set alone; the number of parts follows from a class of sizes, and a set near
the upper end of its class gives parts for the next class too.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

CHUNK = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
ALL = 0xFFFFFFFFFFFFFFFF


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers; no two become equal."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(8)
def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@lru_cache(1)
def lowered() -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of all texts, and the number of the text it is in."""
    data = np.frombuffer(b" ".join(texts).translate(lowered()) + b" ", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[0::2], edge[1::2]
    room = 1 << max(16, int(len(data)).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, room)[: len(data)], out=sums[1:])
    back = powers(pow(BASE, -1, 1 << 64), room)
    hashes = (sums[end] - sums[begin]) * back[begin]
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    owner = np.searchsorted(np.cumsum(sizes), begin, side="right")
    return mixed(hashes ^ ((end - begin).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))), owner


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted by text and hash, and each text's count.

    A text of fewer words has its whole sequence as its one shingle, if it has a word.
    """
    words, owner = word_hashes(texts)
    count = np.bincount(owner, minlength=len(texts))
    n = len(words)
    total = np.zeros(max(0, n - width + 1), np.uint64)
    for i in range(width):
        total = mixed(total + np.uint64(i + 1)) + words[i : i + len(total)]
    own = owner[: len(total)]
    whole = own == owner[width - 1 : width - 1 + len(total)]
    hashes, owners = mixed(total[whole]), own[whole]
    first = np.cumsum(count) - count
    short = np.flatnonzero((count > 0) & (count < width))
    few = np.zeros(len(short), np.uint64)
    for i in range(width - 1):
        has = count[short] > i
        nth = words[first[short[has]] + i]
        few[has] = mixed(few[has] + np.uint64(i + 1)) + nth
    few = mixed(few ^ (count[short].astype(np.uint64) << np.uint64(56)))
    hashes, owners = np.concatenate([hashes, few]), np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[keep], owners[keep]
    return hashes, np.bincount(owners, minlength=len(texts))


def digests(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit number for each set, from its hashes; equal for equal sets."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        at = (np.cumsum(sizes) - sizes)[full]
        sums = np.add.reduceat(mixed(hashes ^ np.uint64(0x165667B19E3779F9)), at)
        out[full] = mixed(sums ^ sizes[full].astype(np.uint64))
    return out


class Scheme:
    """Signatures for sets of which the intersection is ``percent`` of the union or more.

    A set gives its ``spare`` parts more than can differ, those with the smallest signatures:
    as many of them are common to similar sets (or all that must be, if they are fewer).
    """

    def __init__(self, percent: int, spare: int = 12) -> None:
        self.percent, self.spare = percent, spare

    def differing(self, size: np.ndarray) -> np.ndarray:
        """How many shingles of either set can be missing in the other."""
        # The union is at most size * 100 / percent, and the rest of it lies in one set only.
        return size * (100 - self.percent) // self.percent

    def parts(self, size_class: int) -> int:
        """Parts for sets below 2 ** (size_class + 1): more than can differ, with some spare."""
        return int(1.03 * self.differing(np.int64(2 << size_class))) + 9

    def signatures(self, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each part of all sets: signature, number of the set, its class, and its need.

        The need is the number of parts that a similar set has in common with it. A set
        that can differ in nothing gives no parts: it is similar to equal sets only.
        """
        start = np.cumsum(sizes) - sizes
        usable = np.flatnonzero(self.differing(sizes) > 0)
        own = np.floor(np.log2(np.maximum(sizes[usable], 1))).astype(np.int64)
        upper = sizes[usable] * 100 >= self.percent * (2 << own)
        none = np.empty(0, np.int64)
        found = [(none.astype(np.uint64), none, none, none)]
        for size_class in np.unique(np.concatenate([own, own[upper] + 1])).tolist():
            some = usable[(own == size_class) | (upper & (own + 1 == size_class))]
            found.append(self.in_class(hashes, sizes, start, some, size_class))
        return tuple(np.concatenate(columns) for columns in zip(*found))

    def in_class(self, hashes, sizes, start, some, size_class: int):
        n = sizes[some]
        rows = np.repeat(np.arange(len(some)), n)
        at = np.repeat(start[some] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        own = hashes[at]
        many = np.uint64(self.parts(size_class))
        part = ((own >> np.uint64(32)) * many) >> np.uint64(32)
        # Hashes are sorted, so a part is a run of them.
        head = np.ones(len(own), bool)
        head[1:] = (part[1:] != part[:-1]) | (rows[1:] != rows[:-1])
        first = np.flatnonzero(head)
        value = np.add.reduceat(mixed(own ^ np.uint64(0x85EBCA77C2B2AE63)), first)
        salt = part[first] + (np.uint64(size_class) << np.uint64(32))
        value = mixed(value ^ mixed(salt))
        row = rows[first]
        order = np.lexsort((value, row))
        value, row = value[order], row[order]
        filled = np.bincount(row, minlength=len(some))
        need = np.minimum(filled - self.differing(n), self.spare)
        place = np.arange(len(row)) - np.repeat(np.cumsum(filled) - filled, filled)
        keep = place < (self.differing(n) + np.maximum(need, 0))[row]
        keep |= (need <= 0)[row]
        value, row = value[keep], row[keep]
        # Sets with too few filled parts may agree in empty parts only: they all meet.
        lacking = np.flatnonzero(need <= 0)
        meet = mixed(np.full(len(lacking), (size_class << 40) + 1, np.uint64))
        row = np.concatenate([row, lacking])
        classes = np.full(len(row), size_class)
        return np.concatenate([value, meet]), some[row], classes, np.maximum(need, 0)[row]


def chunks(texts: list[bytes], most: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts with about ``most`` bytes together, and the place of the first."""
    begin = held = 0
    for i, text in enumerate(texts):
        if i > begin and held + len(text) > most:
            yield begin, texts[begin:i]
            begin, held = i, 0
        held += len(text) + 1
    if begin < len(texts):
        yield begin, texts[begin:]
