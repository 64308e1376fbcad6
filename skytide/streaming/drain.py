"""Bounded and resumable transfer of a bulk topic into an archive."""

from __future__ import annotations

import hashlib
import threading
import uuid
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytide.naming import DEFAULT_NAMING, SCHEMA_TOPIC_SUFFIX, Naming
from skytide.operators.archive import check_archive_arguments, with_partitions
from skytide.operators.decode import decode_alerts, topic_schema
from skytide.operators.offsets import (
    commit_offsets, plan_ranges, read_committed, read_ranges, record_run, topic_bounds, unfinished_run,
)
from skytide.operators.topics import check_transfer_topic
from skytide.sources.avro_files import write_avro
from skytide.sources.avro_schema import avro_to_struct_type, prune
from skytide.session import open_filesystem, qualified
from skytide.sources.topic_log import latest_positions, read_topics
from skytide.streaming.progress import ProgressLog

# Fixed value: empty looks at a topic before it counts as drained.
MAX_IDLE = 4

MOVED = "moved"  # what a drain observes of its messages


@dataclass(frozen=True)
class TransferJob:
    """What to move where.

    Raising ``generation`` restarts the group from the beginning: a generation
    has its own checkpoint and its own output, so each holds every message once.
    """

    topic: str
    archive: str
    checkpoints: str
    group: str = "default"
    survey: str = "ztf"
    partition_by: str | None = "time"
    out_format: str = "parquet"
    log_path: str | None = None
    kafka: dict | None = None
    schema: str | None = None
    columns: list[str] | None = None
    with_offsets: bool = False
    gather_partitions: bool = False
    generation: int = 0
    per_trigger: int | None = None
    progress: str | None = None
    naming: Naming = field(default=DEFAULT_NAMING)

    def __post_init__(self):
        check_transfer_topic(self.topic)
        check_archive_arguments(self.partition_by, self.survey, self.out_format, self.naming)

    @property
    def checkpoint(self) -> str:
        safe = hashlib.sha256(f"{self.group}\0{self.topic}".encode()).hexdigest()[:16]
        return f"{self.checkpoints.rstrip('/')}/{safe}/{self.generation}"

    @property
    def run_group(self) -> str:
        """The group that bounded runs commit under: each generation has its own offsets."""
        return self.group if self.generation == 0 else f"{self.group} generation {self.generation}"

    @property
    def output(self) -> str:
        base = self.archive.rstrip("/")
        return base if self.generation == 0 else f"{base}-generation-{self.generation}"

    def writer_schema(self, spark: SparkSession) -> str:
        if self.schema is not None:
            return self.schema
        messages = read_topics(spark, [self.topic + SCHEMA_TOPIC_SUFFIX], self.log_path, kafka=self.kafka)
        return topic_schema(messages, self.topic)


def decoded_rows(raw: DataFrame, job: TransferJob, schema: str) -> tuple[DataFrame, list[str]]:
    """Alerts of the topic's one schema, flat, with their partition columns.

    Message keys are ignored here: a bulk topic has a single schema.
    """
    target = avro_to_struct_type(schema)
    keyless = raw.withColumn("key", F.lit(None).cast("binary"))
    decoded = decode_alerts(keyless, target, override=schema, columns=job.columns)
    extra = ["topic", "partition", "offset"] if job.with_offsets else []
    names = prune(target, job.columns).fieldNames()
    flat = decoded.select(*[F.col(c) for c in extra if c not in names], *[F.col("alert")[n].alias(n) for n in names])
    return with_partitions(flat, job.partition_by, job.survey, job.naming)


def start_drain(spark: SparkSession, job: TransferJob, schema: str | None = None):
    """Start one query that reads what the topic holds now and then stops."""
    schema = schema or job.writer_schema(spark)
    # Spark ends a query that takes what is available after one batch of a source whose
    # admission it does not know: small batches of a log go on to the ends it has now.
    stepwise = bool(job.per_trigger) and job.log_path is not None
    until = latest_positions(spark, [job.topic], job.log_path) if stepwise else None
    raw = read_topics(spark, [job.topic], job.log_path, True, kafka=job.kafka, per_trigger=job.per_trigger, until=until)
    if job.progress:
        raw = raw.observe(MOVED, F.count(F.lit(1)).alias("messages"), F.sum(F.octet_length("value")).alias("bytes"))
    rows, partitions = decoded_rows(raw, job, schema)
    query = rows.writeStream.option("checkpointLocation", job.checkpoint)
    query = query if stepwise else query.trigger(availableNow=True)
    if job.out_format == "avro":
        # A retried batch writes to the same folder again, so it replaces itself.
        def write(batch: DataFrame, batch_id: int) -> None:
            write_avro(batch, f"{job.output}/batch={batch_id}", mode="overwrite")

        started = query.foreachBatch(write).start()
    else:
        started = query.format("parquet").option("path", job.output).outputMode("append").partitionBy(*partitions).start()
    return stop_when_drained(started) if stepwise else started


def stop_when_drained(query):
    """Stop a query, from a thread of its own, once it has handled all that its source gives."""

    def wait():
        try:
            query.processAllAvailable()
            query.stop()
        except Exception:  # the query has failed or was stopped: whoever waits for it is told
            return

    threading.Thread(target=wait, daemon=True).start()
    return query


def run_to_end(query, poll_seconds: float = 1.0) -> int:
    """Wait for a bounded query and return how many messages it read.

    Spark keeps only the latest progress reports, so they are gathered while
    the query runs.
    """
    rows: dict[int, int] = {}
    done = False
    while not done:
        done = query.awaitTermination(poll_seconds)
        for report in query.recentProgress:
            rows[report["batchId"]] = max(rows.get(report["batchId"], 0), report["numInputRows"])
    return sum(rows.values())


def drain_topic(spark: SparkSession, job: TransferJob, max_idle: int = MAX_IDLE, runs_path: str | None = None) -> int:
    """Drain until ``max_idle`` looks in a row find nothing new; returns the
    number of messages moved. New data resets the count of idle looks.

    With ``runs_path`` the offsets that a look is sure to have moved, those the
    topic held when it began, are committed after it for the backlog report. With
    ``job.progress`` every micro-batch's offsets and counts are kept there.
    """
    schema = job.writer_schema(spark)
    moved = idle = 0
    with ProgressLog(spark, job.progress) if job.progress else nullcontext() as progress:
        while idle < max_idle:
            held = _new_ranges(spark, job, runs_path) if runs_path else []
            query = start_drain(spark, job, schema)
            found = run_to_end(query)
            if progress is not None:
                progress.wait(query)
            commit_offsets(spark, runs_path, job.run_group, held) if held else None
            moved += found
            idle = 0 if found else idle + 1
    return moved


def _new_ranges(spark: SparkSession, job: TransferJob, runs_path: str):
    committed = read_committed(spark, runs_path, job.run_group)
    bounds = topic_bounds(spark, [job.topic], job.log_path, job.kafka, committed)
    return [r for r in plan_ranges(bounds, committed, None) if r[3] > r[2]]


def transfer_limited(spark: SparkSession, job: TransferJob, runs_path: str, limit: int | None) -> int:
    """Move the next ``limit`` messages of the topic as one batch job.

    The offset ranges of a run are planned and recorded first, its rows go to a
    folder of its own, and the offsets are committed last. A run that died on
    the way is repeated with the same ranges into the same folder before
    anything new is planned, so runs follow each other without gap or repeat.
    ``None`` is no limit, 0 moves nothing.
    """
    filesystem, inner = open_filesystem(qualified(spark, job.output))
    if filesystem.get_file_info(f"{inner}/_spark_metadata").type != FileType.NotFound:
        raise ValueError(f"{job.output} belongs to a streaming drain; bounded runs need an archive of their own")
    pending = unfinished_run(spark, runs_path, job.run_group, [job.topic])
    if pending is not None:
        run_id, ranges = pending
    else:
        committed = read_committed(spark, runs_path, job.run_group)
        ranges = plan_ranges(topic_bounds(spark, [job.topic], job.log_path, job.kafka, committed), committed, limit)
        if not any(end > start for _, _, start, end in ranges):
            return 0
        run_id = uuid.uuid4().hex
        record_run(spark, runs_path, job.run_group, run_id, ranges, done=False)
    batch = read_ranges(spark, ranges, job.log_path, job.kafka)
    rows, partitions = decoded_rows(batch, job, job.writer_schema(spark))
    folder = f"{job.output}/run={run_id}"
    if job.out_format == "avro":
        write_avro(rows, folder, mode="overwrite")
    else:
        # A backlog of many days on many tasks would give tasks x days files.
        rows = rows.hint("rebalance", *partitions) if job.gather_partitions and partitions else rows
        rows.write.mode("overwrite").partitionBy(*partitions).parquet(folder)
    record_run(spark, runs_path, job.run_group, run_id, ranges, done=True)
    return sum(end - start for _, _, start, end in ranges)
