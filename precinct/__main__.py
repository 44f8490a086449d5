"""Command line: ``python -m precinct etl|reports|patterns|publish|stream``."""

import argparse
import os

from pyspark.sql import functions as F

from precinct.operators.records import to_messages
from precinct.plans import batch, incremental, stream
from precinct.plans.scratch import release, stored
from precinct.session import build_session
from precinct.sinks import documents, files as file_sinks, jdbc, messages
from precinct.sinks.collection import Collection
from precinct.sources import files, streams
from precinct.streaming import runner


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="precinct")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("etl", help="raw CSV to the curated table")
    job.add_argument("--raw", required=True)
    job.add_argument("--curated", required=True)
    job.add_argument("--show", action="store_true")
    job.add_argument(
        "--lay-out", action="store_true", help="sort along a curve over place and month"
    )

    job = jobs.add_parser("reports", help="curated table to the report tables")
    job.add_argument("--curated", required=True)
    job.add_argument("--out", help="folder for Parquet reports")
    job.add_argument(
        "--totals", help="folder of totals by year: only years that changed are added up again"
    )
    job.add_argument("--jdbc-url")
    job.add_argument("--jdbc-driver")
    job.add_argument("--jdbc-user", default="")
    job.add_argument("--jdbc-connections", type=int, help="tasks that write at a time")
    job.add_argument("--incidents-table", default="incidents")
    job.add_argument("--show", action="store_true")

    job = jobs.add_parser("patterns", help="curated table to the historical patterns")
    job.add_argument("--curated", required=True)
    job.add_argument("--out", required=True)
    job.add_argument(
        "--any-location",
        action="store_true",
        help="one pattern per type, hour and weekday, so that no incident is repeated",
    )

    job = jobs.add_parser("publish", help="raw CSV to messages")
    job.add_argument("--raw", required=True)
    job.add_argument("--servers")
    job.add_argument("--topic")
    job.add_argument("--out", help="folder that stands for the topic")

    job = jobs.add_parser("stream", help="messages to the five collections")
    job.add_argument("--patterns", required=True)
    job.add_argument("--out", required=True, help="folder for incidents and collections")
    job.add_argument("--checkpoints", required=True)
    job.add_argument("--store", help="format of a document store's connector, instead of files")
    job.add_argument(
        "--store-option",
        action="append",
        default=[],
        help="NAME=VALUE for the connector; {collection} stands for the collection's name",
    )
    job.add_argument("--servers")
    job.add_argument("--topic")
    job.add_argument("--messages", help="folder that stands for the topic")
    job.add_argument("--session-id", default="default")
    job.add_argument("--console", action="store_true", help="also print the hotspots")
    job.add_argument("--correlation-salts", type=int)
    job.add_argument(
        "--pack",
        type=int,
        help="keep collections with a commit log and pack so many folders into one",
    )
    job.add_argument(
        "--list-types",
        action="store_true",
        help="hotspots list the type of each incident, which must fit into one row",
    )
    job.add_argument("--once", action="store_true", help="take what is available and end")
    return parser.parse_args()


def _reports(spark, args) -> None:
    curated = files.curated(spark, args.curated)
    targets = [args.show, args.out, args.jdbc_url]
    if not any(targets):
        raise SystemExit("reports: give --out, --jdbc-url or --show")
    if args.jdbc_url and not args.jdbc_connections:
        raise SystemExit("reports: --jdbc-url needs --jdbc-connections")

    def write(frame, table):
        if sum(map(bool, targets)) > 1 and table != args.incidents_table:
            frame = stored(frame, "report")
        if args.show:
            file_sinks.preview(frame)
        if args.out:
            frame.write.mode("overwrite").parquet(f"{args.out}/{table}")
        if args.jdbc_url:
            password = os.environ.get("JDBC_PASSWORD", "")
            options = jdbc.jdbc_options(
                args.jdbc_url,
                table,
                args.jdbc_user,
                password,
                args.jdbc_driver,
                args.jdbc_connections,
            )
            jdbc.write_jdbc(frame, options)

    built = None
    if args.totals:
        built = incremental.build_reports(spark, args.curated, args.totals)
    batch.publish_reports(curated, write, args.incidents_table, built)


def _publish(spark, args) -> None:
    records = to_messages(files.raw_csv(spark, args.raw), F.current_timestamp())
    if args.topic:
        messages.publish_kafka(records, args.servers, args.topic)
    else:
        messages.publish_files(records, args.out)


def _collection(name: str, args) -> documents.BatchWriter:
    """Where the results of a collection go: files, or a document store."""
    if args.pack and not args.store:
        return Collection(f"{args.out}/{name}", args.session_id, args.pack).write
    if not args.store:
        return documents.file_collection(f"{args.out}/{name}", args.session_id)
    options = dict(option.split("=", 1) for option in args.store_option)
    named = {key: value.replace("{collection}", name) for key, value in options.items()}
    identity = stream.COLLECTIONS[name]
    return documents.store_collection(args.store, named, identity, args.session_id)


def _stream(spark, args) -> None:
    if args.topic:
        source = streams.kafka_messages(spark, args.servers, args.topic)
    else:
        source = streams.file_messages(spark, args.messages)
    every = None if args.once else runner.DOCUMENT_TRIGGER
    incidents = f"{args.out}/incidents"
    parsing, schema = stream.store_incidents(source, incidents, args.checkpoints, every)
    if args.once:
        runner.drain([parsing])
    results = stream.transformations(
        stream.stored_incidents(spark, f"{incidents}/accepted", schema),
        lambda session: batch.current_patterns(session, args.patterns),
        args.correlation_salts,
        "list" if args.list_types else "counts",
    )
    writers = {name: _collection(name, args) for name in results}
    if args.console:
        name = "stream_crime_hotspots"
        writers[name] = documents.to_all(writers[name], documents.console())
    batch.current_patterns(spark, args.patterns)  # fails here if there are none
    queries = runner.start_all(results, writers, args.checkpoints, every)
    if args.once:
        runner.drain(queries.values())
    else:
        runner.watch(spark, [parsing, *queries.values()])


def main() -> None:
    args = _arguments()
    spark = build_session(f"precinct-{args.job}")
    try:
        _run(spark, args)
    finally:
        release(spark)


def _run(spark, args) -> None:
    if args.job == "etl":
        curated = batch.build_curated(spark, args.raw, args.curated, args.lay_out)
        if args.show:
            file_sinks.preview(curated)
    elif args.job == "reports":
        _reports(spark, args)
    elif args.job == "patterns":
        curated = files.curated(spark, args.curated)
        batch.build_patterns(curated, args.out, per_location=not args.any_location)
    elif args.job == "publish":
        _publish(spark, args)
    else:
        _stream(spark, args)


if __name__ == "__main__":
    main()
