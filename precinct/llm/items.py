"""Terms of texts, and tables of items (test questions, queries) in slices of bounded size.

Terms are runs of digits, letters A-Z (lower-cased) and characters beyond ASCII. In UTF-8 the
latter are runs of bytes from 0x80 on, so texts are taken apart as bytes.
"""

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import running
from precinct.plans.scratch import stored

# Bytes of text that are taken apart at once.
PIECE = 1 << 20
# Bytes of item texts in a slice; what is broadcast at once.
SLICE = 1 << 20


def lowered(byte: int) -> int:
    """The byte in a term, or a blank for one that stands in no term."""
    char = chr(byte)
    if byte >= 0x80 or char in "0123456789" or "a" <= char <= "z":
        return byte
    return byte + 32 if "A" <= char <= "Z" else 32


TERM_BYTES = bytes(map(lowered, range(256)))


def term_runs(data: bytes, most: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text in order, in runs of about ``most`` bytes."""
    blanked = data.translate(TERM_BYTES)
    begin, size = 0, len(blanked)
    while begin < size:
        end = begin + most
        if end < size:
            # A run ends before a blank; a term longer than a run is not divided.
            end = blanked.rfind(b" ", begin + 1, end)
            if end < 0:
                end = blanked.find(b" ", begin + most)
            end = end if end > 0 else size
        yield blanked[begin:end].split()
        begin = end


class Item(NamedTuple):
    number: int
    name: str | None
    data: bytes


class Items:
    """A table of items, stored, and divided into slices of about ``most`` bytes of text.

    Equal rows are one item. Items without text are left out, as they have no terms.
    """

    def __init__(self, items: DataFrame, item_id: str, text: str, most: int = SLICE) -> None:
        rows = items.select(items[item_id].alias("item_id"), items[text].alias("text"))
        rows = rows.filter("text IS NOT NULL").distinct()
        numbered = stored(rows.withColumn("item_no", F.monotonically_increasing_id()), "items")
        sized = numbered.withColumn("_all", F.lit(0))
        size = {"first": F.octet_length("text") + 64}
        placed = running(sized, ["_all"], ["item_no"], size, numbered.count())
        part = F.floor(F.col("first") / most).cast("int").alias("slice")
        self.table = stored(placed.select("item_no", "item_id", "text", part), "item-slices")
        self.count = 1 + (self.table.agg(F.max("slice")).first()[0] or 0)

    def names(self) -> DataFrame:
        return self.table.select("item_no", "item_id")

    def slice(self, number: int) -> list[Item]:
        """Items of one slice; its bytes are bounded, but for the last of its items."""
        rows = self.table.filter(F.col("slice") == number).select(
            "item_no", F.col("item_id").cast("string"), F.col("text").cast("binary")
        )
        return [Item(n, name, bytes(data)) for n, name, data in rows.collect()]
