"""Ingest of messages: each micro-batch is parsed once and divided in one pass.

- ``accepted``: enriched incidents, for the transformations
- ``rejected``: messages that are no usable record, with the reason and their own text
- ``late``: accepted incidents that come too late for windows of some results, with these

Lateness is decided here, once for all results. Every accepted row carries the watermark of
its micro-batch, that is the latest arrival of all earlier micro-batches less the delay, and
transformations leave out windows that had ended by then. Queries that read the accepted rows
have watermarks no later than that, so nothing is dropped that is not in ``late``.

Busy cells are recognised here too. A heavy-hitter sketch of the cells is taken of every
micro-batch, in the same pass, and kept with the state. A cell that has more rows per time
slot than one state partition should hold is salted from the first slot on that no row has
been seen of; for earlier slots its salts stay what they were, so both sides of the
correlation always agree on the salts of a cell and slot.

The state is a small file per micro-batch. A micro-batch that is repeated after a failure
finds its predecessor's state, makes the same rows, and leaves what is there already.
"""

import base64
import json
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from precinct.functions import geo
from precinct.operators.correlation import SLOT_SECONDS, slot_of, touched_slots
from precinct.operators.records import enrich, judged
from precinct.plans import folders
from precinct.schema import ENVELOPE

OUTCOMES = ("accepted", "rejected", "late")
# States that are kept for a look back; the counts in them are totals since the start.
KEPT_STATES = 20
_SKETCH = "sketch struct<sketch:binary,maxItemsTracked:int,itemDataType:string,itemDataTypeDDL:string>"


class Busy(NamedTuple):
    """When a cell is salted: by its rows per time slot."""

    rows_per_state: int = 50_000
    most_salts: int = 64
    # Cells that a sketch keeps count of, and slots after which a new one is begun.
    tracked: int = 1_000
    slots: int = 72


class Ingest:
    """Writer of micro-batches of messages into the folders of ``path``.

    ``lateness`` gives, by the name of a result, the number of windows that a row with a
    ``watermark`` misses.
    """

    def __init__(
        self,
        path: str,
        delay_seconds: int,
        lateness: Mapping[str, Callable[[], Column]],
        busy: Busy = Busy(),
    ) -> None:
        self.path, self.delay_seconds = path, delay_seconds
        self.lateness, self.busy = lateness, busy

    def folder(self, outcome: str) -> str:
        return f"{self.path}/{outcome}"

    def prepare(self, spark: SparkSession) -> None:
        """Make the folders, so that readers can start before the first micro-batch."""
        for outcome in OUTCOMES:
            folders.make(spark, self.folder(outcome))

    def schema(self, spark: SparkSession) -> StructType:
        """Columns of accepted rows."""
        none = self.divided(spark.createDataFrame([], ENVELOPE), {})
        return none.drop("key", "value", "rejected_because", "missed").schema

    def read(self, spark: SparkSession, outcome: str) -> DataFrame:
        """All rows of an outcome so far."""
        schema = self.divided(spark.createDataFrame([], ENVELOPE), {}).schema
        return spark.read.schema(schema).parquet(self.folder(outcome))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self.state(spark, batch_id - 1)
        rows = self.divided(batch, before)
        seen = Observation(f"ingest-{batch_id}")
        rejected, late = F.col("rejected_because").isNotNull(), F.size("missed") > 0
        counted = rows.observe(
            seen,
            F.count("*").alias("messages"),
            F.count_if(rejected).alias("rejected"),
            F.count_if(late).alias("late"),
            F.max(F.when(~rejected, F.unix_micros("event_time"))).alias("latest"),
            F.approx_count_distinct(F.when(~rejected, slot_of(F.col("event_time")))).alias("slots"),
            F.expr(f"approx_top_k_accumulate({_BUSY_CELL}, {self.busy.tracked})").alias("sketch"),
        )
        outcome = (
            F.when(rejected, F.array(F.lit("rejected")))
            .when(late, F.array(F.lit("accepted"), F.lit("late")))
            .otherwise(F.array(F.lit("accepted")))
        )
        staged = f"{self.path}/_staged/{batch_id}"
        out = counted.select("*", F.explode(outcome).alias("outcome"))
        own = {name: F.when(F.col("outcome") == "rejected", F.col(name)) for name in ("key", "value")}
        out.withColumns(own).write.mode("overwrite").partitionBy("outcome").parquet(staged)
        for name in OUTCOMES:
            made = f"{staged}/outcome={name}"
            if folders.exists(spark, made):
                folders.move(spark, made, f"{self.folder(name)}/batch_id={batch_id}")
        folders.remove(spark, staged)
        self.keep(spark, batch_id, self.following(spark, before, seen.get))

    def divided(self, messages: DataFrame, state: dict) -> DataFrame:
        """All messages as incidents, with why they are rejected and which windows they miss."""
        rows = enrich(judged(messages))
        watermark = F.lit(None).cast("timestamp")
        if state.get("latest") is not None:
            watermark = F.timestamp_micros(F.lit(state["latest"] - 1_000_000 * self.delay_seconds))
        rows = rows.withColumns({"watermark": watermark, "cell_salts": self.salts(state)})
        missed = F.array(
            *(
                F.struct(F.lit(name).alias("collection"), F.coalesce(windows(), F.lit(0)).alias("windows"))
                for name, windows in self.lateness.items()
            )
        )
        some = F.filter(missed, lambda m: F.col("rejected_because").isNull() & (m["windows"] > 0))
        return rows.withColumn("missed", some)

    def salts(self, state: dict) -> Column:
        """Salts of the row's cell in each slot it touches; null for all but busy cells."""
        known = {
            cell: [{"since": since, "salts": salts} for since, salts in steps]
            for cell, steps in state.get("cells", {}).items()
        }
        kind = "map<string,array<struct<since:bigint,salts:int>>>"
        steps = F.try_element_at(F.from_json(F.lit(json.dumps(known)), kind), _cell())

        def at(slot: Column) -> Column:
            reached = F.transform(F.filter(steps, lambda s: s["since"] <= slot), lambda s: s["salts"])
            return F.coalesce(F.try_element_at(reached, F.lit(-1)), F.lit(1))

        return F.when(steps.isNotNull(), F.transform(touched_slots(F.col("event_time")), at))

    # ------------------------------------------------------------ state

    def state(self, spark: SparkSession, batch_id: int) -> dict:
        """What is known after a micro-batch; nothing before the first."""
        path = f"{self.path}/_state/{batch_id:012d}.json"
        return json.loads(folders.read_text(spark, path)) if batch_id >= 0 else {}

    def last(self, spark: SparkSession) -> dict:
        """The newest state: totals of messages by outcome, latest arrival, salted cells."""
        found = folders.names(spark, f"{self.path}/_state")
        kept = [int(name.removesuffix(".json")) for name in found if name.endswith(".json")]
        return self.state(spark, max(kept, default=-1))

    def keep(self, spark: SparkSession, batch_id: int, state: dict) -> None:
        base = f"{self.path}/_state"
        folders.write_text(spark, f"{base}/{batch_id:012d}.json", json.dumps(state))
        if batch_id >= KEPT_STATES:
            folders.remove(spark, f"{base}/{batch_id - KEPT_STATES:012d}.json")

    def following(self, spark: SparkSession, before: dict, seen: dict) -> dict:
        totals = before.get("totals", {})
        counts = {name: seen[name] for name in ("messages", "rejected", "late")}
        counts["accepted"] = seen["messages"] - seen["rejected"]
        state = {
            "totals": {name: totals.get(name, 0) + n for name, n in counts.items()},
            "latest": max((x for x in (before.get("latest"), seen["latest"]) if x is not None), default=None),
            "cells": before.get("cells", {}),
            "sketches": before.get("sketches", []),
        }
        if state["latest"] is None:
            return state
        slot = state["latest"] // (1_000_000 * SLOT_SECONDS)
        # A micro-batch may span many slots: a backlog must not count as the rows of one. Slots
        # that have rows are counted, so that one row of a wrong time does not stretch the span.
        since = slot + 1 - max(1, seen["slots"])
        if before.get("latest") is not None:
            since = max(since, before["latest"] // (1_000_000 * SLOT_SECONDS))
        state["sketches"] = self.added(spark, state["sketches"], seen["sketch"], min(since, slot), slot)
        state["cells"] = self.steps(state["cells"], self.rates(spark, state["sketches"], slot), slot)
        return state

    def added(self, spark: SparkSession, sketches: list, new: Row, since: int, slot: int) -> list:
        """Sketches of the last two periods; ``new``, of rows from slot ``since`` on, goes into the
        younger one."""
        kept = [dict(sketch) for sketch in sketches]
        if not kept or slot - kept[-1]["slot"] >= self.busy.slots:
            return [*kept[-1:], {"slot": since, "sketch": _to_text(new)}]
        kept[-1]["sketch"] = _to_text(self.combined(spark, [kept[-1]["sketch"]], new))
        return kept

    def combined(self, spark: SparkSession, texts: list[dict], *more: Row) -> Row:
        rows = [(_from_text(text),) for text in texts] + [(row,) for row in more]
        # One partition: the function fails on an empty one.
        frame = spark.createDataFrame(rows, _SKETCH).coalesce(1)
        both = F.expr(f"approx_top_k_combine(sketch, {self.busy.tracked})").alias("sketch")
        return frame.agg(both).first()["sketch"]

    def rates(self, spark: SparkSession, sketches: list, slot: int) -> dict[str, float]:
        """Rows per slot of the cells that the sketches know."""
        whole = self.combined(spark, [sketch["sketch"] for sketch in sketches])
        found = spark.createDataFrame([(whole,)], _SKETCH).select(
            F.expr(f"approx_top_k_estimate(sketch, {self.busy.tracked})").alias("top")
        )
        slots = slot - sketches[0]["slot"] + 1
        return {e["item"]: e["count"] / slots for e in found.first()["top"] if e["item"]}

    def steps(self, cells: dict, rates: dict[str, float], slot: int) -> dict:
        """Salts by cell, as steps of (slot from which on, salts)."""
        busy, out = self.busy, {}
        for cell in sorted({*cells, *rates}):
            wanted = -(-rates.get(cell, 0) // busy.rows_per_state)
            wanted = int(min(busy.most_salts, max(1, wanted)))
            steps = [list(step) for step in cells.get(cell, [])]
            now = steps[-1][1] if steps else 1
            # Fewer salts only when half would do, so that they do not swing.
            if wanted > now or 2 * wanted <= now:
                steps = [s for s in steps if s[0] <= slot] + [[slot + 1, wanted]]
            # Rows of slots long past are late for the correlation: one step back is enough.
            past = [s for s in steps if s[0] <= slot - 2 * busy.slots]
            steps = [*past[-1:], *(s for s in steps if s[0] > slot - 2 * busy.slots)]
            if any(salts > 1 for _, salts in steps):
                out[cell] = steps
        return out


def _cell() -> Column:
    return geo.grid_key(F.col("latitude"), F.col("longitude"), 2)


# Rows that a domestic incident is compared with: their cell, or null.
_BUSY_CELL = (
    "CASE WHEN rejected_because IS NULL AND NOT domestic THEN "
    "concat(CAST(round(latitude, 2) AS STRING), '_', CAST(round(longitude, 2) AS STRING)) END"
)


def _to_text(sketch: Row) -> dict:
    values = sketch.asDict()
    return {**values, "sketch": base64.b64encode(bytes(values["sketch"])).decode()}


def _from_text(text: dict) -> Row:
    return Row(**{**text, "sketch": base64.b64decode(text["sketch"])})
