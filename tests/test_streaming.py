import json

import pytest
from pyspark.sql import functions as F

from skytide.operators import offsets
from skytide.operators.archive import read_store, store_batch
from skytide.session import scratch_path, small_table
from skytide.sources.avro_files import read_alerts
from skytide.sources.avro_schema import avro_to_struct_type
from skytide.sources.topic_log import LOG_SCHEMA, to_topic_log, write_topic_log
from skytide.streaming import drain
from skytide.streaming.drain import TransferJob, drain_topic, start_drain, transfer_limited
from skytide.streaming.live import LiveJob, run_limited, start_live, stored_alerts

TOPIC = "ftransfer_ztf_2026-03-23_11487"
SCHEMA = {
    "type": "record",
    "name": "alert",
    "fields": [
        {"name": "objectId", "type": "string"},
        {"name": "candid", "type": "long"},
        {"name": "cdsxmatch", "type": ["string", "null"]},
        {
            "name": "candidate",
            "type": {
                "type": "record",
                "name": "candidate",
                "fields": [
                    {"name": "jd", "type": "double"},
                    {"name": "fid", "type": "int"},
                    *[{"name": n, "type": ["double", "null"]} for n in ("magpsf", "sigmapsf", "diffmaglim")],
                ],
            },
        },
    ],
}
POINT = [("jd", "double"), ("fid", "int"), ("magpsf", "double"), ("sigmapsf", "double"), ("diffmaglim", "double")]


def alerts_frame(spark, first, n):
    i = F.col("id")
    return spark.range(first, first + n).select(
        F.concat(F.lit("ZTF"), (i % 7).cast("string")).alias("objectId"),
        i.alias("candid"),
        F.when(i % 3 == 0, "Star").alias("cdsxmatch"),
        F.struct(
            (F.lit(2460311.0) + i / 10).alias("jd"),
            (i % 2 + 1).cast("int").alias("fid"),
            (i / 4).alias("magpsf"),
            F.lit(0.1).alias("sigmapsf"),
            F.lit(20.5).alias("diffmaglim"),
        ).alias("candidate"),
    )


def add_messages(spark, path, first, n, topic=TOPIC, key=None):
    partition = F.col("candid") % 3
    to_topic_log(
        alerts_frame(spark, first, n), SCHEMA, F.lit(topic), partition, F.lit(key).cast("string"), ["candid"],
        F.timestamp_seconds("candid"), path,
    )


def announce(spark, path, topic=TOPIC):
    rows = [(bytearray(json.dumps(SCHEMA).encode()), None, topic + "_schema", 0, 0, None, 0)]
    write_topic_log(spark.createDataFrame(rows, LOG_SCHEMA), path)


@pytest.fixture
def log(spark):
    path = scratch_path(spark, "log")
    for first in (0, 10, 20):
        add_messages(spark, path, first, 10)
    announce(spark, path)
    return path


def job(spark, log, **more):
    return TransferJob(
        topic=TOPIC, archive=scratch_path(spark, "out"), checkpoints=scratch_path(spark, "cp"), log_path=log, **more
    )


def candids(spark, path):
    return sorted(r.candid for r in spark.read.parquet(path).select("candid").collect())


def test_log_offsets_continue_after_an_append(spark, log):
    got = spark.read.schema(LOG_SCHEMA).parquet(log).filter(F.col("topic") == TOPIC)
    per_partition = {r.partition: sorted(r.o) for r in got.groupBy("partition").agg(F.collect_list("offset").alias("o")).collect()}
    assert per_partition == {p: list(range(10)) for p in range(3)}


def test_small_batches_equal_one_batch(spark, log):
    small, big = job(spark, log, per_trigger=1), job(spark, log)
    assert drain_topic(spark, small) == drain_topic(spark, big) == 30
    assert spark.read.parquet(small.output).exceptAll(spark.read.parquet(big.output)).isEmpty()
    expected = alerts_frame(spark, 0, 30)
    got = spark.read.parquet(big.output).select(*expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert {(r.year, r.month, r.day) for r in spark.read.parquet(big.output).collect()} == {
        ("2024", "01", f"{d:02d}") for d in range(1, 5)}


def test_drain_goes_on_where_it_stopped(spark, log):
    transfer = job(spark, log, partition_by=None)
    assert drain_topic(spark, transfer, max_idle=1) == 30
    assert drain_topic(spark, transfer, max_idle=2) == 0
    add_messages(spark, log, 30, 5)
    assert drain_topic(spark, transfer, max_idle=1) == 5
    assert candids(spark, transfer.output) == list(range(35))
    fresh = TransferJob(**{**transfer.__dict__, "generation": 1})
    assert drain_topic(spark, fresh, max_idle=1) == 35
    assert candids(spark, fresh.output) == candids(spark, transfer.output) == list(range(35))


def test_a_query_killed_between_batches_loses_and_repeats_nothing(spark, log):
    transfer = job(spark, log, partition_by=None, per_trigger=1)
    query = start_drain(spark, transfer)
    while not query.recentProgress and query.isActive:
        query.awaitTermination(1)
    query.stop()
    drain_topic(spark, transfer, max_idle=1)
    assert candids(spark, transfer.output) == list(range(30))


def test_class_partitions_columns_and_offsets(spark, log):
    transfer = job(spark, log, partition_by=None, columns=["candid", "candidate.jd"], with_offsets=True)
    drain_topic(spark, transfer, max_idle=1)
    back = spark.read.parquet(transfer.output)
    assert set(back.columns) == {"topic", "partition", "offset", "candid", "candidate"}
    assert back.filter("candid % 3 <> partition or candid div 3 <> offset").isEmpty()


def test_avro_output(spark, log):
    transfer = job(spark, log, out_format="avro")
    assert drain_topic(spark, transfer, max_idle=1) == 30
    back = read_alerts(spark, f"{transfer.output}/batch=0")
    assert sorted(r.candid for r in back.collect()) == list(range(30))


def test_bad_jobs_are_refused(spark, log):
    for wrong in (dict(topic="rrlyr"), dict(partition_by="hour"), dict(survey="lsst", partition_by="tnsclass"), dict(out_format="csv")):
        with pytest.raises(ValueError):
            TransferJob(**{**job(spark, log).__dict__, **wrong})
    other = TransferJob(**{**job(spark, log).__dict__, "topic": "fxmatch_x"})
    with pytest.raises(LookupError, match="no schema"):
        drain_topic(spark, other)


def test_limited_runs_follow_each_other(spark, log):
    transfer, runs = job(spark, log, partition_by=None, with_offsets=True), scratch_path(spark, "runs")
    assert transfer_limited(spark, transfer, runs, 0) == 0
    moved = [transfer_limited(spark, transfer, runs, 7) for _ in range(3)]
    assert moved == [7, 7, 7]
    assert len(candids(spark, transfer.output)) == len(set(candids(spark, transfer.output))) == 21
    assert transfer_limited(spark, transfer, runs, None) == 9
    assert candids(spark, transfer.output) == list(range(30))
    assert transfer_limited(spark, transfer, runs, None) == 0


def test_a_limited_run_that_died_is_repeated_once(spark, log, monkeypatch):
    transfer, runs = job(spark, log), scratch_path(spark, "runs")
    record = drain.record_run

    def dies_before_commit(*args, done):
        if done:
            raise RuntimeError("driver lost")
        record(*args, done=done)

    monkeypatch.setattr(drain, "record_run", dies_before_commit)
    with pytest.raises(RuntimeError):
        transfer_limited(spark, transfer, runs, 12)
    monkeypatch.undo()
    add_messages(spark, log, 30, 6)
    assert transfer_limited(spark, transfer, runs, 5) == 12  # the lost run first
    assert transfer_limited(spark, transfer, runs, None) == 24
    assert candids(spark, transfer.output) == list(range(36))


def test_bounded_runs_keep_out_of_a_streaming_archive(spark, log):
    transfer = job(spark, log)
    drain_topic(spark, transfer, max_idle=1)
    with pytest.raises(ValueError, match="archive of their own"):
        transfer_limited(spark, transfer, scratch_path(spark, "runs"), 3)


# -- live ---------------------------------------------------------------------
@pytest.fixture
def live_log(spark):
    path = scratch_path(spark, "live")
    add_messages(spark, path, 0, 10, "one", "2.7")
    add_messages(spark, path, 10, 10, "two", json.dumps(SCHEMA))
    return path


def live_job(spark, log, **more):
    settings = dict(
        topics=["one", "two"],
        checkpoint=scratch_path(spark, "live-cp"),
        target=avro_to_struct_type(SCHEMA),
        log_path=log,
        registry={"2.7": json.dumps(SCHEMA)},
        archive=scratch_path(spark, "live-archive"),
    )
    return LiveJob(**{**settings, **more})


def with_history(schema):
    item = {"type": "record", "name": "past", "fields": [{"name": n, "type": [t, "null"]} for n, t in POINT]}
    return {**schema, "fields": schema["fields"] + [{"name": "prv_candidates", "type": [{"type": "array", "items": item}, "null"]}]}


def test_live_saves_notifies_and_summarises(spark, live_log):
    config = small_table(
        spark,
        [dict(topic="one", kind="telegram", channel="@c", secret_name="s")],
        "topic string, kind string, channel string, secret_name string",
    )
    # Reading with a wider schema than the writer's: history is null.
    live = live_job(
        spark, live_log, target=avro_to_struct_type(with_history(SCHEMA)), outbox=scratch_path(spark, "outbox"),
        topic_config=config, kinds=["telegram"], summary=scratch_path(spark, "summary"), display=True,
    )
    start_live(spark, live, available_now=True).awaitTermination()
    stored = stored_alerts(spark, live)
    assert sorted(r.alert_key for r in stored.collect()) == sorted(f"ZTF{i % 7}_{i}" for i in range(20))
    box = spark.read.parquet(live.outbox)
    assert box.count() == 20 and box.filter("route_status = 'routed'").count() == 10
    assert box.filter("not_before is not null").select("not_before").distinct().count() == 10
    assert spark.read.parquet(live.summary).select("topic", "objectId").count() == 20
    # New messages only, and a repeated alert replaces itself.
    add_messages(spark, live_log, 18, 4, "two", json.dumps(SCHEMA))
    start_live(spark, live, available_now=True).awaitTermination()
    assert stored_alerts(spark, live).count() == 22
    assert spark.read.parquet(live.archive).count() == 24


def test_store_keeps_first_or_last_and_replays_a_batch(spark, path):
    def batch(rows):
        return spark.createDataFrame(rows, "k int, v string, o int")

    def seen(mode):
        return sorted((r.k, r.v) for r in read_store(spark, path, ["k"], ["o"], mode).collect())

    store_batch(batch([(1, "a", 0), (2, "a", 1), (2, "b", 2)]), path, 0, ["k"])
    for _ in range(2):
        store_batch(batch([(1, "c", 0), (3, "c", 1)]), path, 10, ["k"])
    store_batch(batch([(3, "d", 0)]), path, 9, ["k"])
    assert seen("overwrite") == [(1, "c"), (2, "b"), (3, "c")]
    assert seen("ignore") == [(1, "a"), (2, "a"), (3, "d")]
    with pytest.raises(IOError, match="alert 1 already exists"):
        store_batch(batch([(1, "x", 0)]), path, 11, ["k"], "error")
    with pytest.raises(IOError, match="alert 5 already exists"):
        store_batch(batch([(5, "x", 0), (5, "y", 1)]), path, 11, ["k"], "error")
    for _ in range(2):  # a repeated batch does not clash with itself
        store_batch(batch([(6, "x", 0)]), path, 11, ["k"], "error")
    with pytest.raises(ValueError):
        store_batch(batch([]), path, 12, ["k"], "merge")


def test_limited_live_runs(spark, live_log):
    config = small_table(
        spark,
        [dict(topic=t, kind="slack", channel="#c", secret_name="s") for t in ("one", "two")],
        "topic string, kind string, channel string, secret_name string",
    )
    live = live_job(
        spark, live_log, target=avro_to_struct_type(with_history(SCHEMA)), outbox=scratch_path(spark, "outbox"),
        topic_config=config, kinds=["slack"],
    )
    runs = scratch_path(spark, "live-runs")
    assert run_limited(spark, live, runs, 0) == 0
    assert [run_limited(spark, live, runs, 8) for _ in range(3)] == [8, 8, 4]
    assert run_limited(spark, live, runs, None) == 0
    assert stored_alerts(spark, live).count() == spark.read.parquet(live.archive).count() == 20
    # One channel: every message has its own slot, over all three runs.
    due = sorted(r.not_before for r in spark.read.parquet(live.outbox).select("not_before").collect())
    assert len(due) == 20 and min((b - a).total_seconds() for a, b in zip(due, due[1:])) >= 2


def test_live_dead_letters(spark, live_log):
    live = live_job(spark, live_log, registry={}, dead_letters=scratch_path(spark, "dead"))
    start_live(spark, live, available_now=True).awaitTermination()
    assert spark.read.parquet(live.archive).count() == 10
    dead = spark.read.parquet(live.dead_letters)
    assert {(r.topic, r.error) for r in dead.collect()} == {("one", "unknown schema '2.7'")} and dead.count() == 10


def test_live_fails_fast_without_dead_letters(spark, live_log):
    query = start_live(spark, live_job(spark, live_log, registry={}), available_now=True)
    with pytest.raises(Exception, match="unknown schema"):
        query.awaitTermination()


def test_backlog_of_the_log(spark, log):
    raw = spark.read.schema(LOG_SCHEMA).parquet(log)
    none = offsets.read_committed(spark, scratch_path(spark, "none"), "g")
    report = offsets.backlog_report(raw, none, [TOPIC]).filter("partition is null").first()
    assert (report.offset, report.lag) == (0, 30)
