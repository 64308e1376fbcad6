"""Jobs for ``spark-submit``: transfer, stream, topics and backlog.

``spark-submit --py-files skytide.zip skytide/jobs.py transfer --topic …``
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from skytide.naming import SURVEYS, Naming
from skytide.operators.archive import FORMATS, STORE_MODES
from skytide.operators.decode import load_registry, registry_from_folder, schema_table
from skytide.operators.offsets import backlog_of_bounds, read_committed, topic_bounds
from skytide.operators.summary import print_rows
from skytide.operators.topics import topic_catalogue
from skytide.session import build_session
from skytide.sources.avro_schema import superset, version_order
from skytide.sources.log_index import log_bounds
from skytide.sources.topic_log import all_topics, read_topics
from skytide.streaming.drain import MAX_IDLE, TransferJob, drain_topic, transfer_limited
from skytide.streaming.live import LiveJob, run_limited, settle_days, start_live
from skytide.streaming.progress import progress_bounds


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="skytide", description=__doc__)
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--log-path", help="topic-log table; Kafka when left out")
    shared.add_argument("--kafka", type=json.loads, default={}, help="client configuration as JSON")
    shared.add_argument("--namespace", default="broker", help="name in front of the deployment's topics")
    shared.add_argument("--portal-host", default="portal.example.org")
    shared.add_argument("--survey", choices=SURVEYS, default="ztf")
    commands = parser.add_subparsers(dest="command", required=True)

    transfer = commands.add_parser("transfer", parents=[shared], help="move a bulk topic into an archive")
    transfer.add_argument("--topic", required=True)
    transfer.add_argument("--archive", required=True)
    transfer.add_argument("--checkpoints", required=True)
    transfer.add_argument("--group", default="default")
    transfer.add_argument("--partition-by", default="time", help="time, <namespace>class, tnsclass, classId or none")
    transfer.add_argument("--out-format", choices=FORMATS, default="parquet")
    transfer.add_argument("--generation", type=int, default=0, help="raise to restart from the beginning")
    transfer.add_argument("--limit", type=int, help="exact number of messages of this run")
    transfer.add_argument("--per-trigger", type=int)
    transfer.add_argument("--max-idle", type=int, default=MAX_IDLE)
    transfer.add_argument("--progress", help="table for the offsets and counts of every batch")
    transfer.add_argument("--dump-schemas", help="also write the schemas seen as a table")

    stream = commands.add_parser("stream", parents=[shared], help="archive, notify and show live alerts")
    stream.add_argument("--topics", nargs="+", required=True)
    stream.add_argument("--schemas", required=True, help="folder of schema files")
    stream.add_argument("--schema", help="one schema file for messages that carry none")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--start", choices=["earliest", "latest"], default="earliest")
    stream.add_argument("--archive")
    stream.add_argument("--archive-mode", choices=STORE_MODES, default="overwrite")
    stream.add_argument("--outbox")
    stream.add_argument("--topic-config", help="Parquet table topic, kind, channel, secret_name")
    stream.add_argument("--notify", nargs="*", default=[], choices=["telegram", "slack"])
    stream.add_argument("--dead-letters")
    stream.add_argument("--summary", help="table of display rows, one folder per batch")
    stream.add_argument("--display", action="store_true")
    stream.add_argument("--poll-seconds", type=float)
    stream.add_argument("--limit", type=int, help="handle this many alerts as one batch, then stop")
    stream.add_argument("--settle-before", help="when done, settle the archived days before this one (YYYY-MM-DD)")
    stream.add_argument("--until-drained", action="store_true", help="stop when nothing is left")

    listing = commands.add_parser("topics", parents=[shared], help="topics and their service")
    listing.add_argument("--service")
    listing.add_argument("--progress", help="topics that queries have reported, without a look at messages")

    backlog = commands.add_parser("backlog", parents=[shared], help="offset and lag per topic partition")
    backlog.add_argument("--topics", nargs="+", required=True)
    backlog.add_argument("--runs", required=True, help="table of committed offsets")
    backlog.add_argument("--group", default="default")
    backlog.add_argument("--progress", help="ends that queries have reported, without a look at messages")
    return parser


def _transfer(spark: SparkSession, args, naming: Naming) -> None:
    job = TransferJob(
        topic=args.topic,
        archive=args.archive,
        checkpoints=args.checkpoints,
        group=args.group,
        survey=args.survey,
        partition_by=None if args.partition_by.lower() == "none" else args.partition_by,
        out_format=args.out_format,
        log_path=args.log_path,
        kafka=args.kafka,
        generation=args.generation,
        per_trigger=args.per_trigger,
        progress=args.progress,
        naming=naming,
    )
    if args.dump_schemas:
        # The schema topic announces the schemas; the bulk topic itself is not read for them.
        messages = read_topics(spark, [f"{args.topic}_schema"], args.log_path, kafka=args.kafka)
        schema_table(messages).write.mode("overwrite").parquet(args.dump_schemas)
    runs = f"{args.checkpoints.rstrip('/')}/runs"
    if args.limit is None:
        moved = drain_topic(spark, job, args.max_idle, runs)
    else:
        moved = transfer_limited(spark, job, runs, args.limit)
    print(f"{moved} messages moved to {job.output}")


def _stream(spark: SparkSession, args, naming: Naming) -> None:
    registry = load_registry(registry_from_folder(spark, args.schemas, naming, args.survey))
    override = None
    if args.schema:
        override = spark.read.text(args.schema, wholetext=True).first().value
    versions = [registry[v] for v in sorted(registry, key=version_order)] + ([override] if override else [])
    job = LiveJob(
        topics=args.topics,
        checkpoint=args.checkpoint,
        target=superset(versions),
        survey=args.survey,
        log_path=args.log_path,
        kafka=args.kafka,
        registry=registry,
        override=override,
        start=args.start,
        archive=args.archive,
        archive_mode=args.archive_mode,
        outbox=args.outbox,
        topic_config=spark.read.parquet(args.topic_config) if args.topic_config else None,
        kinds=args.notify,
        display=args.display,
        summary=args.summary,
        runs=f"{args.checkpoint.rstrip('/')}-runs",
        dead_letters=args.dead_letters,
        poll_seconds=args.poll_seconds,
        naming=naming,
    )
    if args.limit is not None:
        handled = run_limited(spark, job, f"{args.checkpoint.rstrip('/')}-runs", args.limit)
        print(f"{handled} alerts handled")
    else:
        start_live(spark, job, available_now=args.until_drained).awaitTermination()
    if args.settle_before:
        print(f"{len(settle_days(spark, job, args.settle_before))} partitions settled")


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    naming = Naming(args.namespace, args.portal_host)
    spark = build_session()
    if args.command == "transfer":
        _transfer(spark, args, naming)
    elif args.command == "stream":
        _stream(spark, args, naming)
    elif args.command == "topics":
        if args.progress:
            known = progress_bounds(spark, args.progress)
        else:
            known = log_bounds(spark, args.log_path) if args.log_path else all_topics(spark, kafka=args.kafka)
        print_rows(topic_catalogue(known, args.service, naming).orderBy("topic"))
    else:
        committed = read_committed(spark, args.runs, args.group)
        if args.progress:
            bounds = progress_bounds(spark, args.progress, args.topics)
        else:
            bounds = topic_bounds(spark, args.topics, args.log_path, args.kafka, committed)
        report = backlog_of_bounds(bounds, committed, args.topics)
        print_rows(report.orderBy("topic", F.col("partition").asc_nulls_last()))


if __name__ == "__main__":
    main()
