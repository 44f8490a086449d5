
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import replay  # noqa: E402
from oracle import ORACLE  # noqa: E402
from precinct.functions import geo  # noqa: E402
from precinct.operators import etl, layout, records, reports  # noqa: E402
from precinct.operators.correlation import domestic_correlation  # noqa: E402
from precinct.operators.escalation import violence_escalation  # noqa: E402
from precinct.operators.hotspots import (  # noqa: E402
    hotspot_counts,
    hotspots,
    hotspots_from_counts,
)
from precinct.operators.order import with_position  # noqa: E402
from precinct.operators.patterns import historical_patterns, match_patterns  # noqa: E402
from precinct.operators.temporal import temporal_patterns  # noqa: E402
from precinct.plans import batch, incremental, stream  # noqa: E402
from precinct.plans.scratch import new_folder, stored  # noqa: E402
from precinct.session import configure  # noqa: E402
from precinct.sinks import documents, files as file_sinks, messages as message_sinks  # noqa: E402
from precinct.sinks.collection import Collection  # noqa: E402
from precinct.sources import files, tables  # noqa: E402
from precinct.sources.streams import file_messages  # noqa: E402
from precinct.streaming import runner  # noqa: E402
from precinct.streaming.ingest import Busy  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def _plain(frame: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, which compare equal in any client zone."""
    zoned = [name for name, kind in frame.dtypes if kind == "timestamp"]
    return frame.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(build(configure(spark), folder))

    return run


# ---------------------------------------------------------------- inputs


def _incidents(spark, folder):
    return records.enrich(tables.events(spark, folder))


def _messages(spark, folder):
    raw = tables.as_raw(tables.events(spark, folder), "crime_date", "event_time")
    return records.to_messages(raw, "event_time")


def _damaged_messages(spark, folder):
    """All messages, some of them cut short, without an ID or without a date."""
    row = F.col("key").cast("bigint")
    value = (
        F.when(row % 97 == 0, F.expr("substring(value, 1, 40)"))
        .when(row % 89 == 0, F.replace("value", F.lit('"ID"'), F.lit('"Id"')))
        .when(row % 83 == 0, F.replace("value", F.lit('"Date":"'), F.lit('"Date":"x')))
        .otherwise(F.col("value"))
    )
    return _messages(spark, folder).withColumn("value", value)


def _stored_patterns(spark, folder, per_location=True):
    history = tables.events(spark, folder)
    return stored(historical_patterns(history, "crime_date", per_location), "patterns")


# ---------------------------------------------------------------- sources and sinks


def _raw_csv_folder(spark, folder):
    """All orders as raw CSV text, with a quoted comma and a column nobody reads."""
    raw = tables.raw_orders(spark, folder).withColumn("Block", F.lit("unused"))
    path = new_folder(spark, "raw")
    file_sinks.write_curated(raw.select("Block", *raw.drop("Block").columns), path, "csv")
    return path


def src_csv_raw(spark, folder):
    return etl.select_renamed(files.raw_csv(spark, _raw_csv_folder(spark, folder)))


def src_csv_column_orders(spark, folder):
    """Raw CSV text in two folders, whose files have their columns in different order."""
    raw = tables.raw_orders(spark, folder)
    even = F.col("ID").cast("bigint") % 2 == 0
    paths = [new_folder(spark, "raw"), new_folder(spark, "raw")]
    file_sinks.write_curated(raw.filter(even), paths[0], "csv")
    file_sinks.write_curated(raw.filter(~even).select(*reversed(raw.columns)), paths[1], "csv")
    return etl.select_renamed(files.raw_csv(spark, paths))


def src_curated(spark, folder):
    path = new_folder(spark, "curated")
    file_sinks.write_curated(tables.curated_orders(spark, folder), path, partition_by=["year"])
    return files.curated(spark, path)


def sink_curated_roundtrip(spark, folder):
    path = new_folder(spark, "curated")
    return batch.build_curated(spark, _raw_csv_folder(spark, folder), path)


def src_inline(spark, folder):
    patterns = historical_patterns(files.inline_history(spark, "2024-02-01 10:00:00"))
    return match_patterns(_incidents(spark, folder), patterns)


def src_stream_envelope(spark, folder):
    path = new_folder(spark, "messages")
    replay.write_slices(_messages(spark, folder), path)
    result = replay.run_to_end(spark, path, lambda source: {"envelope": source})
    return result["envelope"]


def publish_json(spark, folder):
    path = new_folder(spark, "messages")
    message_sinks.publish_files(_messages(spark, folder), path)
    return spark.read.parquet(path)


def sink_foreachbatch(spark, folder):
    """Every micro-batch is written twice, as after a failure; the result is whole once."""
    source = new_folder(spark, "messages")
    out = new_folder(spark, "collection")
    replay.write_slices(_messages(spark, folder), source)
    once = documents.file_collection(out, "session-1")
    enriched = records.incidents(file_messages(spark, source, files_per_trigger=8))
    twice = documents.to_all(once, once)
    checkpoints = new_folder(spark, "checkpoints")
    runner.drain([runner.start(enriched, "sink_foreachbatch", twice, checkpoints, every=None)])
    stored_rows = spark.read.parquet(out)
    return stored_rows.drop("_inserted_at", "batch_id")


def sink_packed(spark, folder):
    """Sixteen micro-batches, each written twice, in a collection that packs four at a time."""
    source = new_folder(spark, "messages")
    messages = _messages(spark, folder)
    # A file for each slot of the machine, but no file without rows.
    files = max(1, min(spark.sparkContext.defaultParallelism, messages.count() // 1_000))
    replay.write_slices(messages, source, slices=16, files=files)
    target = Collection(new_folder(spark, "collection"), "session-1", pack=4)
    enriched = records.incidents(file_messages(spark, source, files_per_trigger=files))
    twice = documents.to_all(target.write, target.write)
    checkpoints = new_folder(spark, "checkpoints")
    runner.drain([runner.start(enriched, "sink_packed", twice, checkpoints, every=None)])
    return target.read(spark).drop("_inserted_at")


def pattern_documents(spark, folder):
    """Every pattern match as a document, with the number of documents of its identity."""
    matched = match_patterns(_incidents(spark, folder), _stored_patterns(spark, folder))
    identity = stream.COLLECTIONS["stream_pattern_analysis"]
    named = documents.with_identity(matched, identity).select("_id", *identity)
    return named.groupBy("_id").agg(
        *(F.first(name).alias(name) for name in identity), F.count("*").alias("documents")
    ).drop("_id")


# ---------------------------------------------------------------- preparation


def _etl(*steps) -> Query:
    def run(spark, folder):
        frame = tables.raw_orders(spark, folder)
        for step in steps:
            frame = step(frame)
        return frame

    return run


_TYPED = (etl.select_renamed, etl.typed)


def stream_extract(spark, folder):
    return records.extract(records.parse(_damaged_messages(spark, folder)))


def stream_enrich(spark, folder):
    return records.incidents(_damaged_messages(spark, folder))


def geo_grid(spark, folder):
    lat, lon = F.col("latitude"), F.col("longitude")
    return tables.events(spark, folder).select(
        "crime_id",
        geo.grid_key(lat, lon, 2).alias("grid_fine"),
        geo.grid_key(lat, lon, 1).alias("grid_coarse"),
    )


def union_all(spark, folder):
    common = ["crime_id", "primary_type", "location_description", "latitude", "longitude"]
    return (
        tables.events(spark, folder)
        .select(*common)
        .unionByName(tables.orders(spark, folder).select(*common))
    )


# ---------------------------------------------------------------- transformations


def _without_clock(frame):
    return frame.drop("analysis_timestamp")


def _types_as_text(frame):
    return frame.withColumn("crime_types", F.array_join("crime_types", ","))


def _rounded(*names):
    return lambda frame: frame.withColumns({n: F.round(n, 6) for n in names})


def _counts_as_text(frame):
    entries = F.array_sort(F.map_entries("crime_types"))
    text = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return frame.withColumn("crime_types", F.array_join(text, ","))


_FINISH = {
    "t1": lambda frame: _types_as_text(_without_clock(frame)),
    "t1_counts": lambda frame: _counts_as_text(_without_clock(frame)),
    "t2": lambda frame: frame,
    "t3": lambda frame: frame,
    "t4": _rounded("geographic_distance"),
    "t5": _rounded("geographic_dispersion"),
}


def t1_hotspots(spark, folder):
    return _FINISH["t1"](hotspots(_incidents(spark, folder), types="list"))


def t1_hotspots_counts(spark, folder):
    """The form for dense cells: a count per type instead of a list."""
    return _FINISH["t1_counts"](hotspots(_incidents(spark, folder)))


def t2_pattern(spark, folder):
    return match_patterns(_incidents(spark, folder), _stored_patterns(spark, folder))


def t2_pattern_keyed(spark, folder):
    patterns = _stored_patterns(spark, folder, per_location=False)
    return match_patterns(_incidents(spark, folder), patterns)


def t2_pattern_shuffled(spark, folder):
    """The way taken when the patterns are too many to broadcast, with a key spread by salts."""
    patterns = _stored_patterns(spark, folder)
    return match_patterns(_incidents(spark, folder), patterns, salts=4, strategy="merge")


def t3_violence(spark, folder):
    return violence_escalation(_incidents(spark, folder))


def t3_violence_untimed(spark, folder):
    """A tenth of the incidents came without an arrival time: they are in no window."""
    known = F.when(F.col("crime_id") % 10 != 0, F.col("event_time"))
    return violence_escalation(_incidents(spark, folder).withColumn("event_time", known))


def t4_domestic(spark, folder):
    return _FINISH["t4"](domestic_correlation(_incidents(spark, folder)))


def t4_domestic_salted(spark, folder):
    """The way for cells too busy for one task: finer slots and salts."""
    pairs = domestic_correlation(_incidents(spark, folder), slot_minutes=5, salts=4)
    return _FINISH["t4"](pairs)


def t5_temporal(spark, folder):
    return _FINISH["t5"](temporal_patterns(_incidents(spark, folder)))


def t5_temporal_sketch(spark, folder):
    """The form for large vocabularies of places, with equal rows in batches and streams."""
    return _FINISH["t5"](temporal_patterns(_incidents(spark, folder), places="sketch"))


def patterns_history(spark, folder):
    return historical_patterns(tables.events(spark, folder))


# ---------------------------------------------------------------- the same, as streams


def _published(spark, folder):
    path = new_folder(spark, "messages")
    replay.write_slices(_messages(spark, folder), path)
    return path


def _streamed(key: str, transform) -> Query:
    def run(spark, folder):
        source = _published(spark, folder)
        name = f"{key}_stream"
        result = replay.run_to_end(
            spark, source, lambda rows: {name: transform(records.incidents(rows))}
        )
        return _FINISH[key](result[name])

    return run


def _ingested(spark, messages, **options):
    """The ingest run over published ``messages``, and a session to read it as a stream."""
    own = replay.streaming_session(spark)
    path = new_folder(spark, "ingested")
    source = file_messages(own, messages, files_per_trigger=8)
    checkpoints = new_folder(spark, "checkpoints")
    parsing, schema = stream.store_incidents(source, path, checkpoints, every=None, **options)
    runner.drain([parsing])
    target = stream.ingest(path)
    return target, stream.stored_incidents(own, target.folder("accepted"), schema, 8)


def _correlated(spark, messages, **options):
    _, incidents = _ingested(spark, messages, **options)
    found = replay.collections_of(spark, {"t4": domestic_correlation(incidents)})
    return _FINISH["t4"](found["t4"])


def t4_domestic_stream(spark, folder):
    return _correlated(spark, _published(spark, folder))


def t4_hot_cell_stream(spark, folder):
    """A third of the incidents happens in one cell, which is salted while the stream runs."""
    source = new_folder(spark, "messages")
    hot = F.col("crime_id") % 3 == 0
    crowded = tables.events(spark, folder).withColumns(
        {
            "latitude": F.when(hot, 41.5).otherwise(F.col("latitude")),
            "longitude": F.when(hot, -87.75).otherwise(F.col("longitude")),
        }
    )
    raw = tables.as_raw(crowded, "crime_date", "event_time")
    replay.write_slices(records.to_messages(raw, "event_time"), source)
    return _correlated(spark, source, busy=Busy(rows_per_state=8))


def ingest_outcomes(spark, folder):
    """Every message is accepted or rejected, the latter with a reason."""
    path = new_folder(spark, "messages")
    replay.write_slices(_damaged_messages(spark, folder), path)
    target, _ = _ingested(spark, path)
    accepted = target.read(spark, "accepted").select(
        F.col("crime_id").cast("string").alias("key"),
        F.lit("accepted").alias("outcome"),
        F.lit(None).cast("string").alias("reason"),
    )
    rejected = target.read(spark, "rejected").select(
        "key", F.lit("rejected"), F.col("rejected_because")
    )
    return accepted.union(rejected)


def rejected_messages(spark, folder):
    """The text of every message that is no usable record, with its reason."""
    path = new_folder(spark, "messages")
    replay.write_slices(_damaged_messages(spark, folder), path)
    target, _ = _ingested(spark, path)
    rejected = target.read(spark, "rejected")
    return rejected.select("key", F.char_length("value").alias("length"), "rejected_because")


def late_rows(spark, folder):
    """The last quarter of an hour arrives once more: the windows that each result misses."""
    path = new_folder(spark, "messages")
    sent = _messages(spark, folder)
    bounds = replay.write_slices(sent, path)
    replay.publish_slice(sent, path, bounds[-1] - 900_000_001, bounds[-1], files=8)
    target, _ = _ingested(spark, path)
    late = target.read(spark, "late").select("crime_id", F.inline("missed"))
    return late.select("crime_id", "collection", "windows")


def t2_pattern_stream(spark, folder):
    patterns = _stored_patterns(spark, folder)
    return _streamed("t2", lambda rows: match_patterns(rows, patterns))(spark, folder)


def t2_renewed_stream(spark, folder):
    """Patterns of half the history at first; all of it is built after the second micro-batch."""
    path = new_folder(spark, "patterns")
    history = tables.events(spark, folder).withColumnRenamed("crime_date", "date")
    batch.build_patterns(history.filter("crime_id % 2 = 0"), path)
    out, checkpoints = new_folder(spark, "collection"), new_folder(spark, "checkpoints")
    once = documents.file_collection(out, "replay")

    def write(rows, batch_id):
        once(rows, batch_id)
        if batch_id == 1:
            batch.build_patterns(history, path)

    own = replay.streaming_session(spark)
    messages = file_messages(own, _published(spark, folder), files_per_trigger=8)
    found = stream.matched(
        records.incidents(messages), lambda session: batch.current_patterns(session, path)
    )
    runner.drain([runner.start(found, "t2_renewed", write, checkpoints, every=None)])
    return spark.read.schema(found.schema).parquet(out).select(found.schema.fieldNames())


def late_data(spark, folder):
    """The first slice of messages arrives once more at the end: all of it is too late."""
    path = new_folder(spark, "messages")
    sent = _messages(spark, folder)
    bounds = replay.write_slices(sent, path)
    replay.publish_slice(sent, path, bounds[0], bounds[1], files=8)
    result = replay.run_to_end(
        spark, path, lambda rows: {"late_data": violence_escalation(records.incidents(rows))}
    )
    return result["late_data"]


def start_all(spark, folder):
    """All columns of all rows of the five collections: messages are ingested once, five queries run on them."""
    source = _published(spark, folder)
    patterns = _stored_patterns(spark, folder)
    _, enriched = _ingested(spark, source)
    found = replay.collections_of(spark, stream.transformations(enriched, patterns))
    found["stream_crime_hotspots"] = _FINISH["t1_counts"](found["stream_crime_hotspots"])
    combined = None
    for name in stream.COLLECTIONS:
        kinds = dict(sorted(found[name].dtypes))
        parts = [n for n, kind in kinds.items() if kind != "double"]
        numbers = [F.round(n, 6) for n, kind in kinds.items() if kind == "double"]
        numbers += [F.lit(None).cast("double")] * (4 - len(numbers))
        rows = found[name].select(
            F.lit(name).alias("collection"),
            F.concat_ws("|", *(F.coalesce(F.col(n).cast("string"), F.lit("")) for n in parts)).alias("values"),
            *(number.alias(f"n{i}") for i, number in enumerate(numbers)),
        )
        combined = rows if combined is None else combined.unionByName(rows)
    return combined


# ---------------------------------------------------------------- reports


def _report(build) -> Query:
    return lambda spark, folder: build(tables.curated_orders(spark, folder))


def _ordered(build) -> Query:
    """The report with the position of each row in its order."""

    def run(spark, folder):
        return with_position(build(tables.curated_orders(spark, folder)))

    return run


def _published_report(name: str) -> Query:
    """The report as published: added up from the stored summary."""

    def run(spark, folder):
        return batch.build_reports(tables.curated_orders(spark, folder))[name]

    return run


def _incremental_report(name: str) -> Query:
    """The report after the last year was appended to a table whose totals are kept by year."""

    def run(spark, folder):
        path, kept = new_folder(spark, "curated"), new_folder(spark, "totals")
        curated = tables.curated_orders(spark, folder)
        last = curated.agg(F.max("year")).first()[0]
        file_sinks.write_curated(curated.filter(F.col("year") < last), path, partition_by=["year"])
        incremental.refresh(spark, path, kept)
        newest = curated.filter(F.col("year") == last).drop("year")
        newest.write.parquet(f"{path}/year={last}")
        return incremental.build_reports(spark, path, kept)[name]

    return run


def box_incidents(spark, folder):
    """Incidents of a small area in three months, from a table laid out for that."""
    path = new_folder(spark, "laid-out")
    batch.store_laid_out(tables.curated_orders(spark, folder), path, rows_per_file=2_000)
    box = layout.Box(41.4, 41.7, -87.8, -87.6, 3, 5)
    return layout.inside(files.curated(spark, path), box)


_QUERIES: dict[str, Query] = {
    "b01_by_weekday": _report(reports.by_weekday),
    "b02_top_type_year": _report(reports.leading_type_per_year),
    "b03_by_location": _report(reports.by_location),
    "b04_type_arrest": _report(reports.by_type_and_arrest),
    "b05_violent_trend": _report(reports.violent_trend),
    "b06_location_type": _report(reports.by_location_and_type),
    "b07_by_month": _report(reports.by_month),
    "b08_domestic_arrests": _report(reports.domestic_arrests),
    "b09_top_type_season": _report(reports.leading_type_per_season),
    "b10_geo_distribution": _report(reports.geographic_distribution),
    "b01_by_weekday_ordered": _ordered(reports.by_weekday),
    "b05_violent_trend_ordered": _ordered(reports.violent_trend),
    "b06_location_type_ordered": _ordered(reports.by_location_and_type),
    "b10_geo_distribution_ordered": _ordered(reports.geographic_distribution),
    "b01_by_weekday_published": _published_report("crimes_by_day_of_week"),
    "b02_top_type_year_published": _published_report("most_common_crime_by_year"),
    "b03_by_location_published": _published_report("crimes_by_location"),
    "b04_type_arrest_published": _published_report("crimes_vs_arrests"),
    "b05_violent_trend_published": _published_report("violent_crimes_trend"),
    "b06_location_type_published": _published_report("dangerous_locations_by_crime_type"),
    "b07_by_month_published": _published_report("crimes_by_month"),
    "b08_domestic_arrests_published": _published_report("domestic_incidents_arrests"),
    "b09_top_type_season_published": _published_report("crimes_by_season"),
    "b02_top_type_year_incremental": _incremental_report("most_common_crime_by_year"),
    "b06_location_type_incremental": _incremental_report("dangerous_locations_by_crime_type"),
    "b10_geo_distribution_incremental": _incremental_report(reports.GEOGRAPHIC_REPORT),
    "box_incidents": box_incidents,
    "src_csv_raw": src_csv_raw,
    "src_csv_column_orders": src_csv_column_orders,
    "src_curated": src_curated,
    "src_inline": src_inline,
    "src_stream_envelope": src_stream_envelope,
    "sink_curated_roundtrip": sink_curated_roundtrip,
    "sink_foreachbatch": sink_foreachbatch,
    "sink_packed": sink_packed,
    "publish_json": publish_json,
    "pattern_documents": pattern_documents,
    "etl_select_rename": _etl(etl.select_renamed),
    "etl_typed": _etl(*_TYPED),
    "etl_calendar": _etl(*_TYPED, etl.with_calendar),
    "etl_season": _etl(*_TYPED, etl.with_calendar, etl.with_season),
    "etl_geo_filter": _etl(*_TYPED, etl.located),
    "etl_curate": _etl(etl.curate),
    "stream_extract": stream_extract,
    "stream_enrich": stream_enrich,
    "geo_grid": geo_grid,
    "union_all": union_all,
    "historical_patterns": patterns_history,
    "t1_hotspots": t1_hotspots,
    "t1_hotspots_counts": t1_hotspots_counts,
    "t2_pattern": t2_pattern,
    "t2_pattern_keyed": t2_pattern_keyed,
    "t2_pattern_shuffled": t2_pattern_shuffled,
    "t3_violence": t3_violence,
    "t3_violence_untimed": t3_violence_untimed,
    "t4_domestic": t4_domestic,
    "t4_domestic_salted": t4_domestic_salted,
    "t5_temporal": t5_temporal,
    "t5_temporal_sketch": t5_temporal_sketch,
    "t1_hotspots_stream": _streamed(
        "t1",
        lambda rows: runner.Result(
            hotspot_counts(rows), lambda counts: hotspots_from_counts(counts, types="list")
        ),
    ),
    "t1_hotspots_counts_stream": _streamed(
        "t1_counts", lambda rows: runner.Result(hotspot_counts(rows), hotspots_from_counts)
    ),
    "t2_pattern_stream": t2_pattern_stream,
    "t2_renewed_stream": t2_renewed_stream,
    "t3_violence_stream": _streamed("t3", violence_escalation),
    "t4_domestic_stream": t4_domestic_stream,
    "t4_hot_cell_stream": t4_hot_cell_stream,
    "t5_temporal_stream": _streamed("t5", temporal_patterns),
    "t5_temporal_sketch_stream": _streamed(
        "t5", lambda rows: temporal_patterns(rows, places="sketch")
    ),
    "late_data": late_data,
    "late_rows": late_rows,
    "ingest_outcomes": ingest_outcomes,
    "rejected_messages": rejected_messages,
    "start_all": start_all,
}


try:  # the operators for corpora are optional: a library without them is whole
    import corpus_pipeline
    from precinct.llm import queries as corpus
except ModuleNotFoundError as missing:
    print(f"without operators for training corpora: no module {missing.name}", file=sys.stderr)
    corpus = corpus_pipeline = None


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: hotspots over the smallest data set."""
    return queries()["t1_hotspots"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    known = {name: _query(build) for name, build in _QUERIES.items()}
    if corpus:
        known |= corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    return known


def oracle_sql() -> dict[str, str]:
    known = dict(ORACLE)
    if corpus:
        known |= corpus.ORACLE
        if corpus_pipeline.ORACLE_SQL:
            known["pipeline"] = corpus_pipeline.ORACLE_SQL
    return known
