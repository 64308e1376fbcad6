"""Live stream of decoded alerts: save, notify, display."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytide.naming import DEFAULT_NAMING, Naming
from skytide.operators.archive import days_before, read_store, settle_store, store_batch, with_partitions
from skytide.operators.decode import decode_alerts
from skytide.operators.offsets import plan_ranges, read_committed, read_ranges, record_run, topic_bounds, unfinished_run
from skytide.operators.outbox import ChannelState, notification_outbox, throttle
from skytide.operators.summary import alert_key, alert_summary, print_rows
from skytide.session import read_table_if_exists, small_table, staging_scope
from skytide.sources.topic_log import latest_positions, read_topics
from skytide.streaming.drain import stop_when_drained


@dataclass(frozen=True)
class LiveJob:
    topics: list[str]
    checkpoint: str
    target: T.StructType
    survey: str = "ztf"
    log_path: str | None = None
    kafka: dict | None = None
    registry: dict[str, str] | None = None
    override: str | None = None
    start: str | dict[int, int] = "earliest"
    per_trigger: int | None = None
    archive: str | None = None
    archive_mode: str = "overwrite"
    partition_by: str | None = "time"
    outbox: str | None = None
    topic_config: DataFrame | None = None
    kinds: list[str] = field(default_factory=list)
    summary: str | None = None
    display: bool = False
    dead_letters: str | None = None
    poll_seconds: float | None = None
    runs: str | None = None
    group: str = "default"
    naming: Naming = field(default=DEFAULT_NAMING)


def _batch_action(job: LiveJob, commits: bool = True):
    flat = [f.name for f in job.target.fields]

    def act(batch: DataFrame, batch_id: int) -> None:
        with staging_scope():
            handle(batch, batch_id)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if job.dead_letters:
                bad = batch.filter(F.col("error").isNotNull()).drop("alert")
                bad.write.mode("overwrite").parquet(f"{job.dead_letters}/batch={batch_id}")
            log = [c for c in ("topic", "partition", "offset") if c not in flat]
            alerts = batch.filter(F.col("error").isNull()).select(*log, *[F.col("alert")[n].alias(n) for n in flat])
            # Fixed order: save, notify, display. Each output of a batch has its
            # own folder or key, so a replayed batch replaces what it wrote.
            if job.archive:
                keyed = alerts.withColumn("alert_key", alert_key(alerts, job.survey, job.naming))
                dated, partitions = with_partitions(keyed, job.partition_by, job.survey, job.naming)
                store_batch(dated, job.archive, batch_id, ["alert_key"], job.archive_mode, partitions)
            if job.outbox and job.kinds:
                messages = notification_outbox(
                    alerts, job.topic_config, job.survey, job.kinds, job.naming, extra=["partition", "offset"]
                )
                now = F.lit(datetime.now(timezone.utc))
                channels = ChannelState(batch.sparkSession, f"{job.outbox.rstrip('/')}-channels")
                timed = throttle(messages, ["topic", "partition", "offset"], now, busy_until=channels.before(batch_id), by_offset=True)
                written = f"{job.outbox}/batch={batch_id}"
                timed.write.mode("overwrite").option("compression", "zstd").parquet(written)
                channels.keep(batch_id, batch.sparkSession.read.schema(timed.schema).parquet(written))
            if job.summary:
                alert_summary(alerts, job.survey).write.mode("overwrite").parquet(f"{job.summary}/batch={batch_id}")
            if job.display:
                print_rows(alert_summary(alerts, job.survey))
            if job.runs and commits:
                # What every output of the batch holds by now; one row per topic partition.
                ends = batch.groupBy("topic", "partition").agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("end"))
                ranges = [(r.topic, r.partition, r.start, r.end) for r in ends.collect()]
                record_run(batch.sparkSession, job.runs, job.group, f"batch-{batch_id}", ranges, done=True)
        finally:
            batch.unpersist()

    return act


def _decoded(raw: DataFrame, job: LiveJob) -> DataFrame:
    mode = "PERMISSIVE" if job.dead_letters else "FAILFAST"
    return decode_alerts(raw, job.target, job.registry, job.override, mode=mode)


def run_limited(spark: SparkSession, job: LiveJob, runs_path: str, limit: int | None, group: str = "default") -> int:
    """Handle the next ``limit`` alerts of the topics as one batch, then stop.

    Each call goes on where the last one ended. Its outputs need folders of
    their own: they number their batches by run, not by streaming batch. A run
    that died is repeated first, with the same messages and batch number.
    """
    pending = unfinished_run(spark, runs_path, group, job.topics)
    if pending is not None:
        run_id, ranges = pending
    else:
        committed = read_committed(spark, runs_path, group)
        ranges = plan_ranges(topic_bounds(spark, job.topics, job.log_path, job.kafka, committed), committed, limit)
        if not any(end > start for _, _, start, end in ranges):
            return 0
        # The batch number is part of the run: a repeat writes to the same folders,
        # later runs have higher numbers, whatever other topics' runs do meanwhile.
        run_id = f"{time.time_ns()}-{uuid.uuid4().hex}"
        record_run(spark, runs_path, group, run_id, ranges, done=False)
    batch_id = int(run_id.split("-")[0])
    _batch_action(job, commits=False)(_decoded(read_ranges(spark, ranges, job.log_path, job.kafka), job), batch_id)
    record_run(spark, runs_path, group, run_id, ranges, done=True)
    return sum(end - start for _, _, start, end in ranges)


def _decided_start(spark: SparkSession, job: LiveJob):
    """Where a query over a log table begins. ``latest`` is decided once and kept
    beside the checkpoint: a restart must not skip what came while it was down.
    Kafka's own checkpoint keeps it there."""
    if job.start != "latest" or job.log_path is None:
        return job.start
    path = f"{job.checkpoint.rstrip('/')}-start"
    schema = T.StructType.fromDDL("topic string, partition int, offset bigint")
    kept = read_table_if_exists(spark, path, schema)
    if kept is None:
        rows = [dict(topic=t, partition=p, offset=o) for t, p, o in latest_positions(spark, job.topics, job.log_path)]
        small_table(spark, rows, schema).coalesce(1).write.parquet(path)
        kept = spark.read.schema(schema).parquet(path)
    return [(r.topic, r.partition, r.offset) for r in kept.collect()]


def start_live(spark: SparkSession, job: LiveJob, available_now: bool = False):
    """Start the live query: endless with a poll interval, or until what is
    there now has been handled."""
    stepwise = available_now and bool(job.per_trigger) and job.log_path is not None
    until = latest_positions(spark, job.topics, job.log_path) if stepwise else None
    raw = read_topics(spark, job.topics, job.log_path, True, _decided_start(spark, job), job.kafka, job.per_trigger, until)
    query = _decoded(raw, job).writeStream.foreachBatch(_batch_action(job)).option("checkpointLocation", job.checkpoint)
    if stepwise:
        return stop_when_drained(query.start())
    if available_now:
        return query.trigger(availableNow=True).start()
    if job.poll_seconds:
        return query.trigger(processingTime=f"{job.poll_seconds} seconds").start()
    return query.start()


def stored_alerts(spark: SparkSession, job: LiveJob) -> DataFrame:
    """What the live query has archived, one row per alert key."""
    return read_store(spark, job.archive, ["alert_key"], ["partition", "offset"], job.archive_mode)


def settle_days(spark: SparkSession, job: LiveJob, day: str, upto: int | None = None) -> list[str]:
    """Settle the archived days before ``day`` (YYYY-MM-DD), so that reading them needs no look at versions."""
    if job.partition_by != "time":
        raise ValueError("only an archive partitioned by time has days")
    return settle_store(spark, job.archive, ["alert_key"], ["partition", "offset"], days_before(day), job.archive_mode, upto)
