"""Topic logs: Kafka, or a Parquet table with the Kafka source's columns."""

from __future__ import annotations

import json
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytide.operators.decode import encode_alerts
from skytide.operators.numbering import number_rows
from skytide.session import broadcast_if_small, has_kafka, qualified, read_table_if_exists, small_table, staging_scope
from skytide.sources import log_source
from skytide.sources.log_index import index_log, log_bounds

LOG_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
)
LOG_NAMES = [c.split()[0] for c in LOG_SCHEMA.split(", ")]

# What a client uses when its configuration says nothing.
DEFAULT_SERVERS = ("localhost:9093", "localhost:9094", "localhost:9095")
SECURITY_PROTOCOL = "SASL_PLAINTEXT"
SASL_MECHANISM = "SCRAM-SHA-512"

_MAX_FILTER_TERMS = 500


def kafka_options(conf: dict) -> dict[str, str]:
    """Options of Spark's Kafka source for a client configuration.

    Credentials are used only when both user name and password are given.
    Streaming reads start at the earliest offset, not Spark's default latest.
    """
    options = {
        "kafka.bootstrap.servers": conf.get("bootstrap.servers") or ",".join(DEFAULT_SERVERS),
        "startingOffsets": "earliest",
    }
    if conf.get("group.id"):
        options["kafka.group.id"] = conf["group.id"]
    if conf.get("username") is not None and conf.get("password") is not None:
        login = "org.apache.kafka.common.security.scram.ScramLoginModule"
        user, password = (conf[k].replace("\\", "\\\\").replace('"', '\\"') for k in ("username", "password"))
        options["kafka.security.protocol"] = SECURITY_PROTOCOL
        options["kafka.sasl.mechanism"] = SASL_MECHANISM
        options["kafka.sasl.jaas.config"] = f'{login} required username="{user}" password="{password}";'
    return options


EARLIEST, LATEST = -2, -1  # fixed values: what Kafka's source calls a partition's two ends


def starting_offsets_json(topic: str, start: str | dict[int, int], n_partitions: int = 0) -> str:
    """The Kafka source's ``startingOffsets`` for a word or an offset per partition.

    Kafka's source wants every partition of the topic named: of the ``n_partitions``
    those that ``start`` leaves out begin at their beginning.
    """
    if isinstance(start, str):
        if start not in ("earliest", "latest"):
            raise ValueError(f"start position must be earliest or latest, not {start!r}")
        return start
    whole = {p: EARLIEST for p in range(n_partitions)} | start
    return json.dumps({topic: {str(p): o for p, o in sorted(whole.items())}})


def offset_bounds(log: DataFrame) -> DataFrame:
    """First offset and one past the last offset of every topic partition."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("lo"), (F.max("offset") + 1).alias("hi")
    )


def within_ranges(
    log: DataFrame, ranges: list[tuple[str, int, int | None, int | None]], others: bool = False
) -> DataFrame:
    """Rows whose offset lies in ``[start, end)`` of their topic partition; with
    ``others`` also all rows of partitions that are not listed.

    A few hundred ranges become a filter the Parquet scan can use; more become
    a join with the (small) table of ranges.
    """
    if len(ranges) <= _MAX_FILTER_TERMS:
        inside = listed = F.lit(False)
        for topic, partition, start, end in ranges:
            here = term = (F.col("topic") == topic) & (F.col("partition") == partition)
            if start is not None:
                term = term & (F.col("offset") >= start)
            if end is not None:
                term = term & (F.col("offset") < end)
            inside, listed = inside | term, listed | here
        return log.filter(inside | ~listed) if others else log.filter(inside)
    rows = [dict(topic=t, partition=p, _start=s, _end=e) for t, p, s, e in ranges]
    table = small_table(log.sparkSession, rows, "topic string, partition int, _start bigint, _end bigint")
    inside = (F.col("_start").isNull() | (F.col("offset") >= F.col("_start"))) & (
        F.col("_end").isNull() | (F.col("offset") < F.col("_end"))
    )
    joined = log.join(F.broadcast(table), ["topic", "partition"], "left" if others else "inner")
    return joined.filter(inside).select(*log.columns)


def read_topics(
    spark: SparkSession,
    topics: list[str],
    path: str | None = None,
    streaming: bool = False,
    start: str | dict[int, int] | list[tuple[str, int, int]] = "earliest",
    kafka: dict | None = None,
    per_trigger: int | None = None,
    until: list[tuple[str, int, int]] | None = None,
) -> DataFrame:
    """Messages of the given topics from a topic-log table or from Kafka.

    ``start`` is ``earliest``, ``latest`` or an offset per partition (one topic
    only; partitions it leaves out start at their beginning, for which a Kafka
    configuration names how many there are: ``partitions: {topic: n}``); for a table
    also a list of (topic, partition, offset). ``latest`` is looked up anew at each
    call: a restarted stream has to be given what it started with. ``per_trigger``
    bounds the messages of a micro-batch. A stream of a table goes on to the
    offsets ``until``, if they are given. With a checkpoint, a restarted stream goes
    on where it stopped.
    """
    if not topics:
        warnings.warn("no topic given: nothing to read")
    if not isinstance(start, (str, dict, list)) or (isinstance(start, str) and start not in ("earliest", "latest")):
        raise ValueError(f"start position must be earliest, latest or offsets per partition, not {start!r}")
    if isinstance(start, dict) and len(topics) != 1:
        raise ValueError("offsets per partition need exactly one topic")
    if path is None:
        if not has_kafka(spark):
            raise RuntimeError("the Kafka connector is not on the class path; give a topic-log path instead")
        options = kafka_options(kafka or {})
        options["subscribe"] = ",".join(topics)
        counts = (kafka or {}).get("partitions", {})
        options["startingOffsets"] = starting_offsets_json(topics[0] if topics else "", start, counts.get(topics[0], 0) if topics else 0)
        options.update((kafka or {}).get("ranges", {}))
        if per_trigger and streaming:
            options["maxOffsetsPerTrigger"] = str(per_trigger)
        source = spark.readStream if streaming else spark.read
        return source.format("kafka").options(**options).load().select(*LOG_NAMES)
    if start == "latest":
        start = latest_positions(spark, topics, path)
    elif isinstance(start, dict):
        start = [(topics[0], p, o) for p, o in sorted(start.items())]
    if streaming:
        log_source.register(spark)
        index_log(spark, path)
        options = {"path": qualified(spark, path), "topics": json.dumps(topics), "perTrigger": str(per_trigger or "")}
        options["start"] = json.dumps([] if start == "earliest" else start)
        options["until"] = json.dumps(until) if until is not None else ""
        return spark.readStream.schema(LOG_SCHEMA).format("topic_log").options(**options).load()
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    log = log.filter(F.col("topic").isin(*topics)) if topics else log.filter(F.lit(False))
    if start == "earliest":
        return log
    # Partitions without a start of their own are read from their beginning.
    return within_ranges(log, [(t, p, o, None) for t, p, o in start], others=True)


def all_topics(spark: SparkSession, path: str | None = None, kafka: dict | None = None) -> DataFrame:
    """Messages of every topic of a log table, or of every topic the Kafka client may read."""
    if path is not None:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    if not has_kafka(spark):
        raise RuntimeError("the Kafka connector is not on the class path; give a topic-log path instead")
    options = kafka_options(kafka or {}) | {"subscribePattern": ".*"}
    return spark.read.format("kafka").options(**options).load().select(*LOG_NAMES)


def latest_positions(spark: SparkSession, topics: list[str], path: str) -> list[tuple[str, int, int]]:
    """Topic, partition and the offset after the last message of a log table."""
    return [(r.topic, r.partition, r.hi) for r in log_bounds(spark, path, topics).collect()]


def number_messages(df: DataFrame, topic: Column, partition: Column, order: list[str], path: str | None = None) -> DataFrame:
    """Add ``topic``, ``partition`` and ``offset``, dense per partition in the given
    order; offsets go on after those of the log at ``path``, if there is one."""
    placed = df.withColumn("topic", topic).withColumn("partition", partition.cast("int"))
    numbered = number_rows(placed, ["topic", "partition"], order, "offset", "messages")
    existing = read_table_if_exists(df.sparkSession, path, LOG_SCHEMA) if path else None
    if existing is None:
        return numbered
    ends = broadcast_if_small(log_bounds(df.sparkSession, path).select("topic", "partition", "hi"))
    return (
        numbered.join(ends, ["topic", "partition"], "left")
        .withColumn("offset", F.col("offset") + F.coalesce("hi", F.lit(0)))
        .drop("hi")
    )


def write_topic_log(messages: DataFrame, path: str) -> None:
    """Append encoded messages. Laid out by topic so that a subscription reads
    only its own folders; numbered messages come in offset order, so a file
    holds a contiguous range and offset filters skip whole row groups."""
    messages.select(*LOG_NAMES).write.mode("append").option("compression", "zstd").partitionBy("topic").parquet(path)


def to_topic_log(
    df: DataFrame,
    schema: str | dict,
    topic: Column,
    partition: Column,
    key: Column,
    order: list[str],
    timestamp: Column,
    path: str,
    fields: list[str] | None = None,
) -> None:
    """Number rows, encode them and append them to a topic log.

    Numbering comes first: it passes over its input twice, encoding once.
    """
    with staging_scope():
        numbered = number_messages(df, topic, partition, order, path)
        encoded = encode_alerts(numbered, schema, fields, "value")
        meta = {"key": key.cast("binary"), "timestamp": timestamp.cast("timestamp"), "timestampType": F.lit(0)}
        write_topic_log(encoded.withColumns(meta), path)
