"""Offsets, lag and bounded offset ranges of topic partitions."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skytide.session import qualified
from skytide.sources.append_log import AppendLog, Rows
from skytide.sources.log_index import log_bounds
from skytide.sources.topic_log import EARLIEST, LATEST, offset_bounds, read_topics, within_ranges

RUNS_SCHEMA = (
    "consumer_group string, topic string, partition int, start bigint, end bigint, seq bigint, run_id string, done boolean"
)
Range = tuple[str, int, int, int]


# -- committed offsets --------------------------------------------------------
# A table of runs: a bounded run writes its planned ranges before it moves any
# message and writes them again as done afterwards.
def _what_counts(rows: Rows) -> Rows:
    """The last offset committed of each group and partition, and runs not yet done."""
    done = {(r["consumer_group"], r["run_id"]) for r in rows if r["done"]}
    last: dict[tuple, dict] = {}
    for row in rows:
        key = (row["consumer_group"], row["topic"], row["partition"])
        if row["done"] and (key not in last or row["seq"] >= last[key]["seq"]):
            last[key] = row
    return list(last.values()) + [r for r in rows if not r["done"] and (r["consumer_group"], r["run_id"]) not in done]


def runs_log(spark: SparkSession, path: str) -> AppendLog:
    return AppendLog(qualified(spark, path), RUNS_SCHEMA, _what_counts)


def _runs(spark: SparkSession, path: str, group: str) -> DataFrame:
    return runs_log(spark, path).read(spark).filter(F.col("consumer_group") == group)


def read_committed(spark: SparkSession, path: str, group: str) -> DataFrame:
    """Latest committed offset of each topic partition of a consumer group."""
    return (
        _runs(spark, path, group)
        .filter("done")
        .groupBy("topic", "partition")
        .agg(F.max_by("end", "seq").alias("committed"))
    )


def record_run(spark: SparkSession, path: str, group: str, run_id: str, ranges: list[Range], done: bool) -> None:
    """Append a run's ranges, either as planned or as done (which commits their ends)."""
    seq = time.time_ns()
    rows = [
        dict(consumer_group=group, topic=t, partition=p, start=start, end=end, seq=seq, run_id=run_id, done=done)
        for t, p, start, end in ranges
    ]
    runs_log(spark, path).append(rows)


def commit_offsets(spark: SparkSession, path: str, group: str, ranges: list[Range]) -> None:
    record_run(spark, path, group, uuid.uuid4().hex, ranges, done=True)


def unfinished_run(spark: SparkSession, path: str, group: str, topics: list[str]) -> tuple[str, list[Range]] | None:
    """The run of this group and topics that was planned but never finished."""
    runs = _runs(spark, path, group).filter(F.col("topic").isin(*topics))
    states = runs.groupBy("run_id").agg(F.bool_or("done").alias("finished"))
    open_rows = runs.join(states.filter(~F.col("finished")), "run_id", "left_semi").collect()
    if not open_rows:
        return None
    return open_rows[0].run_id, sorted((r.topic, r.partition, r.start, r.end) for r in open_rows)


# -- lag ----------------------------------------------------------------------
def offset_lag(log: DataFrame, committed: DataFrame, partitions: DataFrame | None = None) -> DataFrame:
    """``offset`` and ``lag`` of every topic partition.

    Unknown end (``hi < 0``): no lag. Nothing committed: everything held is
    lag and the offset reads 0. Partitions without messages come from the
    optional ``partitions`` table (topic, partition).
    """
    bounds = offset_bounds(log)
    if partitions is not None:
        bounds = (
            partitions.select("topic", "partition")
            .join(bounds, ["topic", "partition"], "left")
            .fillna(0, ["lo", "hi"])
        )
    return lag_of_bounds(bounds, committed)


def lag_of_bounds(bounds: DataFrame, committed: DataFrame) -> DataFrame:
    """The lag rule on a table ``topic, partition, lo, hi``."""
    lag = (
        F.when(F.col("hi") < 0, F.lit(0))
        .when(F.col("committed").isNull(), F.col("hi") - F.col("lo"))
        .otherwise(F.col("hi") - F.col("committed"))
    )
    return bounds.join(
        committed.select("topic", "partition", "committed"), ["topic", "partition"], "left"
    ).select(
        "topic",
        "partition",
        "lo",
        "hi",
        "committed",
        F.coalesce("committed", F.lit(0)).cast("bigint").alias("offset"),
        lag.cast("bigint").alias("lag"),
    )


def offset_totals(lags: DataFrame) -> DataFrame:
    """Per-topic sums; the topic size is what is read plus what is left."""
    return lags.groupBy("topic").agg(
        F.sum("offset").alias("total_offset"),
        F.sum("lag").alias("total_lag"),
        (F.sum("offset") + F.sum("lag")).alias("topic_size"),
    )


def nonempty_partitions(lags: DataFrame) -> DataFrame:
    return lags.filter(F.col("committed").isNotNull() | (F.col("lag") > 0))


def last_offsets(partitions: DataFrame, committed: DataFrame) -> DataFrame:
    """Committed offset of every listed partition, 0 where there is none."""
    return partitions.join(committed, ["topic", "partition"], "left").select(
        "topic", "partition", F.coalesce("committed", F.lit(0)).cast("bigint").alias("committed")
    )


def partition_counts(log: DataFrame, topics: DataFrame) -> DataFrame:
    """Number of partitions of the asked topics; an unknown topic has 0."""
    counts = log.groupBy("topic").agg(F.countDistinct("partition").alias("n"))
    return topics.select("topic").distinct().join(counts, "topic", "left").select(
        "topic", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_partitions")
    )


def partition_sizes(log: DataFrame) -> DataFrame:
    return offset_bounds(log).select("topic", "partition", (F.col("hi") - F.col("lo")).alias("size"))


def backlog_report(log: DataFrame, committed: DataFrame, topics: list[str]) -> DataFrame:
    """Lag of the subscribed topics, with a total row (null partition) per topic."""
    return backlog_of_bounds(offset_bounds(log), committed, topics)


def backlog_of_bounds(bounds: DataFrame, committed: DataFrame, topics: list[str]) -> DataFrame:
    """The same from a table ``topic, partition, lo, hi``: of a log's index
    (``log_bounds``) or of a query's progress (``progress_bounds``), so that no
    message is read."""
    lags = lag_of_bounds(bounds.filter(F.col("topic").isin(*topics)), committed)
    return lags.rollup("topic", "partition").agg(
        F.sum("offset").alias("offset"), F.sum("lag").alias("lag")
    ).filter(F.col("topic").isNotNull())


def topic_bounds(
    spark: SparkSession, topics: list[str], path: str | None, kafka: dict | None, committed: DataFrame
) -> DataFrame:
    """Where the topics begin and end, one row per topic partition.

    A log table knows from its index. Of Kafka the messages after the committed
    offsets are read; partitions without any stay as they were committed.
    """
    if path is not None:
        return log_bounds(spark, path, topics)
    committed = committed.filter(F.col("topic").isin(*topics) & F.col("committed").isNotNull())
    done = [(r.topic, r.partition, r.committed, None) for r in committed.collect()]
    log = read_topics(spark, topics, kafka=kafka)
    new = offset_bounds(within_ranges(log, done, others=True) if done else log)
    idle = committed.join(new, ["topic", "partition"], "left_anti")
    return new.unionByName(idle.select("topic", "partition", F.col("committed").alias("lo"), F.col("committed").alias("hi")))


# -- bounded ranges -----------------------------------------------------------
def plan_range(bounds: DataFrame, committed: DataFrame, limit: int | None) -> DataFrame:
    """Offset range ``[start, end)`` per partition that delivers ``limit`` messages.

    Lag is spent in partition order, so two runs of N plan what one run of 2N
    would. ``None`` is no limit. The window runs over one row per partition.
    """
    lags = lag_of_bounds(bounds, committed).select(
        "topic",
        "partition",
        F.greatest(F.coalesce("committed", "lo"), "lo").alias("start"),
        "hi",
    )
    available = F.greatest(F.col("hi") - F.col("start"), F.lit(0))
    if limit is None:
        return lags.select("topic", "partition", "start", (F.col("start") + available).alias("end"))
    earlier = W.orderBy("topic", "partition").rowsBetween(W.unboundedPreceding, -1)
    spent = F.coalesce(F.sum(available).over(earlier), F.lit(0))
    granted = F.greatest(F.lit(0), F.least(available, F.lit(limit) - spent))
    return lags.select("topic", "partition", "start", (F.col("start") + granted).alias("end"))


def plan_ranges(bounds: DataFrame, committed: DataFrame, limit: int | None) -> list[Range]:
    """The plan as rows on the driver, one per topic partition; idle ones are empty ranges."""
    plan = plan_range(bounds, committed, limit).collect()
    return sorted((r.topic, r.partition, r.start, r.end) for r in plan)


def read_ranges(spark: SparkSession, ranges: list[Range], path: str | None, kafka: dict | None = None) -> DataFrame:
    """The messages of planned ranges, from a topic-log table or from Kafka."""
    topics = sorted({r[0] for r in ranges})
    wanted = [r for r in ranges if r[3] > r[2]]
    if path is None:
        options = kafka_range_options(ranges, (kafka or {}).get("partitions", {}))
        return within_ranges(read_topics(spark, topics, kafka={**(kafka or {}), "ranges": options}), wanted)
    return within_ranges(read_topics(spark, topics, path), wanted)


def bounded_read(log: DataFrame, committed: DataFrame, limit: int | None) -> tuple[DataFrame, list[Range]]:
    """The next ``limit`` messages of a topic-log table after the committed
    offsets, and the ranges they come from, to be committed once the messages
    are safely stored."""
    ranges = [r for r in plan_ranges(offset_bounds(log), committed, limit) if r[3] > r[2]]
    return within_ranges(log, ranges), ranges


def next_message(log: DataFrame, committed: DataFrame) -> DataFrame:
    """One row: the next message after the committed offsets, or nulls if there is none."""
    found, _ = bounded_read(log, committed, 1)
    return found.agg(F.first(F.struct(*log.columns)).alias("message")).select("message.*")


def kafka_range_options(ranges: list[Range], n_partitions: dict[str, int] | None = None) -> dict[str, str]:
    """A plan as options of a batch read of Kafka.

    Kafka's source wants every partition of a topic named. Those that never held a
    message are in no plan: of the ``n_partitions`` of a topic they are named whole,
    and what may have come into them since is filtered out of the read.
    """

    def by_topic(pick, other):
        out: dict[str, dict[str, int]] = {}
        for row in ranges:
            every = {str(p): other for p in range((n_partitions or {}).get(row[0], 0))}
            out.setdefault(row[0], every)[str(row[1])] = row[pick]
        return json.dumps(out)

    return {"startingOffsets": by_topic(2, EARLIEST), "endingOffsets": by_topic(3, LATEST)}
