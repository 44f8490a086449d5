"""A collection of micro-batches with a commit log, packed into fewer files as it grows.

``data`` holds a folder per micro-batch or pack, ``_log`` a small file per version that lists
the folders of that version. A version appears whole or not at all, and its number is taken
once, so what is listed is complete and each micro-batch is in it once:

- A micro-batch that is repeated after its commit is left out; one that failed before it has
  left a folder that no version lists, which the repeat deletes.
- Folders are packed by level: as soon as a level has ``pack`` folders, they are written anew
  as one folder of the next level. A folder of ``full`` bytes is not packed any more. So there
  are less than ``pack`` folders per level, and levels grow with the logarithm of the batches.
- Packed folders stay for ``kept`` versions, for readers that have begun with an older one.

Read it through the log, with ``read``.
"""

import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from precinct.plans import folders
from precinct.sinks.documents import as_documents

FULL = 1 << 30


class Part(NamedTuple):
    """A folder with the micro-batches ``first`` to ``last``."""

    folder: str
    first: int
    last: int
    level: int


class Version(NamedTuple):
    number: int
    parts: list[Part]
    retired: list[tuple[str, int]]  # folders, and the version that first did without them


class Collection:
    def __init__(
        self, path: str, session_id: str, pack: int = 16, full: int = FULL, kept: int = 16
    ) -> None:
        self.path, self.session_id = path, session_id
        self.pack, self.full, self.kept = pack, full, kept

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Add a micro-batch, once however often it is written; then pack what is due."""
        spark = batch.sparkSession
        name = f"batch-{batch_id:012d}"
        if not _covered(self.version(spark).parts, batch_id):
            for left in folders.names(spark, f"{self.path}/data"):
                if left.startswith(f"{name}-"):
                    folders.remove(spark, f"{self.path}/data/{left}")
            own = self._save(as_documents(batch, self.session_id), name)
            self._commit(spark, [], Part(own, batch_id, batch_id, 0))
        while self._pack_one(spark):
            pass

    def read(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        """All rows of the newest version; ``schema`` is needed only where there may be none."""
        parts = self.version(spark).parts
        if not parts:
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(*(f"{self.path}/data/{part.folder}" for part in parts))

    def version(self, spark: SparkSession) -> Version:
        """The newest version."""
        numbers = [int(n.removesuffix(".json")) for n in self._versions(spark)]
        if not numbers:
            return Version(0, [], [])
        found = json.loads(folders.read_text(spark, self._log(max(numbers))))
        retired = [(folder, number) for folder, number in found["retired"]]
        return Version(max(numbers), [Part(*part) for part in found["parts"]], retired)

    def _versions(self, spark: SparkSession) -> list[str]:
        return [n for n in folders.names(spark, f"{self.path}/_log") if n.endswith(".json") and n[0] != "."]

    def _log(self, number: int) -> str:
        return f"{self.path}/_log/{number:012d}.json"

    def _save(self, frame: DataFrame, name: str) -> str:
        folder = f"{name}-{uuid.uuid4().hex}"
        frame.write.parquet(f"{self.path}/data/{folder}")
        return folder

    def _commit(self, spark: SparkSession, old: list[Part], new: Part) -> bool:
        """A version with ``new`` in place of ``old``; False if another writer was before us."""
        while True:
            now = self.version(spark)
            if not set(old) <= set(now.parts) or (not old and _covered(now.parts, new.first)):
                folders.remove(spark, f"{self.path}/data/{new.folder}")
                return False
            number = now.number + 1
            parts = sorted([*(p for p in now.parts if p not in old), new], key=lambda p: p.first)
            retired = [*now.retired, *((part.folder, number) for part in old)]
            gone = [folder for folder, since in retired if number - since >= self.kept]
            retired = [(folder, since) for folder, since in retired if folder not in gone]
            text = json.dumps({"parts": parts, "retired": retired})
            if folders.write_text(spark, self._log(number), text):
                break
        self._clear(spark, number, gone)
        return True

    def _clear(self, spark: SparkSession, number: int, gone: Iterable[str]) -> None:
        for folder in gone:
            folders.remove(spark, f"{self.path}/data/{folder}")
        for name in self._versions(spark):
            if number - int(name.removesuffix(".json")) >= self.kept:
                folders.remove(spark, f"{self.path}/_log/{name}")

    def _pack_one(self, spark: SparkSession) -> bool:
        """Pack the first level that has enough folders; tells whether there was one."""
        parts = self.version(spark).parts
        for level in sorted({part.level for part in parts}):
            small = [p for p in parts if p.level == level and not self._is_full(spark, p)]
            if len(small) >= self.pack:
                due = small[: self.pack]
                rows = spark.read.parquet(*(f"{self.path}/data/{p.folder}" for p in due))
                # Files of the advisory size, however many files there were.
                own = self._save(rows.hint("rebalance"), f"pack-{due[0].first:012d}")
                return self._commit(spark, due, Part(own, due[0].first, due[-1].last, level + 1))
        return False

    def _is_full(self, spark: SparkSession, part: Part) -> bool:
        return part.level > 0 and folders.size(spark, f"{self.path}/data/{part.folder}") >= self.full


def _covered(parts: Iterable[Part], batch_id: int) -> bool:
    return any(part.first <= batch_id <= part.last for part in parts)
