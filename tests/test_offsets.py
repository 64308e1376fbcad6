import json
import random

import pytest
from pyspark.sql import functions as F

from skytide.operators import numbering, offsets, topics
from skytide.plans import history
from skytide.naming import Naming
from skytide.sources import topic_log
from skytide.sources.topic_log import LOG_SCHEMA, kafka_options, read_topics, within_ranges

BOUNDS = "topic string, partition int, lo bigint, hi bigint"
COMMITTED = "topic string, partition int, committed bigint"


@pytest.mark.parametrize(
    "lo, hi, committed, expected",
    [(0, 5, None, (0, 5)), (0, 5, 3, (3, 2)), (0, 5, 5, (5, 0)), (2, 5, None, (0, 3)), (0, -1, None, (0, 0)), (0, -1, 4, (4, 0))],
)
def test_lag_rule(spark, lo, hi, committed, expected):
    bounds = spark.createDataFrame([("t", 0, lo, hi)], BOUNDS)
    known = spark.createDataFrame([("t", 0, committed)] if committed is not None else [], COMMITTED)
    row = offsets.lag_of_bounds(bounds, known).first()
    assert (row.offset, row.lag) == expected


def log_of(spark, sizes, start=0):
    rows = [(None, b"v", t, p, start + o, None, 0) for (t, p), n in sizes.items() for o in range(n)]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def test_reports(spark):
    log = log_of(spark, {("a", 0): 5, ("a", 1): 2, ("b", 0): 4})
    committed = spark.createDataFrame([("a", 0, 3), ("b", 0, 4)], COMMITTED)
    known = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("b", 0)], "topic string, partition int")
    lags = offsets.offset_lag(log, committed, known)
    assert {(r.topic, r.partition): (r.offset, r.lag) for r in lags.collect()} == {
        ("a", 0): (3, 2), ("a", 1): (0, 2), ("a", 2): (0, 0), ("b", 0): (4, 0)}
    assert {(r.topic, r.partition) for r in offsets.nonempty_partitions(lags).collect()} == {("a", 0), ("a", 1), ("b", 0)}
    totals = {r.topic: (r.total_offset, r.total_lag, r.topic_size) for r in offsets.offset_totals(lags).collect()}
    assert totals == {"a": (3, 4, 7), "b": (4, 0, 4)}
    assert {(r.topic, r.partition): r.committed for r in offsets.last_offsets(known, committed).collect()}[("a", 2)] == 0
    asked = spark.createDataFrame([("a",), ("zzz",)], "topic string")
    assert {r.topic: r.n_partitions for r in offsets.partition_counts(log, asked).collect()} == {"a": 2, "zzz": 0}
    report = {(r.topic, r.partition): (r.offset, r.lag) for r in offsets.backlog_report(log, committed, ["a"]).collect()}
    assert report == {("a", 0): (3, 2), ("a", 1): (0, 2), ("a", None): (3, 4)}


@pytest.mark.parametrize("limit, expected", [(None, [2, 3, 1]), (0, [0, 0, 0]), (1, [1, 0, 0]), (4, [2, 2, 0]), (99, [2, 3, 1])])
def test_planned_ranges_deliver_exactly_the_limit(spark, limit, expected):
    bounds = spark.createDataFrame([("t", 0, 0, 5), ("t", 1, 7, 10), ("t", 2, 0, 1)], BOUNDS)
    committed = spark.createDataFrame([("t", 0, 3), ("t", 1, 2)], COMMITTED)
    plan = sorted(offsets.plan_range(bounds, committed, limit).collect(), key=lambda r: r.partition)
    assert [r.start for r in plan] == [3, 7, 0]
    assert [r.end - r.start for r in plan] == expected


def test_runs_of_a_group_are_kept_apart(spark, path):
    assert offsets.read_committed(spark, path, "g").count() == 0
    offsets.commit_offsets(spark, path, "g", [("t", 0, 0, 5), ("t", 1, 0, 2)])
    offsets.commit_offsets(spark, path, "g", [("t", 0, 5, 8)])
    offsets.commit_offsets(spark, path, "other", [("t", 0, 0, 1)])
    offsets.record_run(spark, path, "g", "r1", [("t", 1, 2, 4)], done=False)
    got = {(r.topic, r.partition): r.committed for r in offsets.read_committed(spark, path, "g").collect()}
    assert got == {("t", 0): 8, ("t", 1): 2}
    assert offsets.unfinished_run(spark, path, "g", ["t"]) == ("r1", [("t", 1, 2, 4)])
    assert offsets.unfinished_run(spark, path, "g", ["u"]) is None
    offsets.record_run(spark, path, "g", "r1", [("t", 1, 2, 4)], done=True)
    assert offsets.unfinished_run(spark, path, "g", ["t"]) is None


def test_ranges_as_filter_and_as_join_agree(spark, monkeypatch):
    log = log_of(spark, {("a", 0): 9, ("a", 1): 9, ("b", 0): 9})
    ranges = [("a", 0, 2, 5), ("a", 1, None, 3), ("b", 0, 7, None)]

    def got():
        return {(r.topic, r.partition, r.offset) for r in within_ranges(log, ranges).collect()}

    def with_others():
        return within_ranges(log, ranges[:2], others=True).count()

    by_filter, wider = got(), with_others()
    assert len(by_filter) == 3 + 3 + 2 and wider == 3 + 3 + 9
    monkeypatch.setattr(topic_log, "_MAX_FILTER_TERMS", 0)
    assert got() == by_filter and with_others() == wider


def test_start_positions(spark, path):
    log_of(spark, {("a", 0): 5, ("a", 1): 3, ("b", 0): 4}).write.partitionBy("topic").parquet(path)

    def seen(topics, start):
        return sorted((r.topic, r.partition, r.offset) for r in read_topics(spark, topics, path, start=start).collect())

    assert len(seen(["a"], "earliest")) == 8 and len(seen(["a", "b"], "earliest")) == 12
    assert seen(["a", "b"], "latest") == []
    assert seen(["a"], {0: 4, 1: 3}) == [("a", 0, 4)]
    with pytest.warns(UserWarning):
        assert seen([], "earliest") == []
    with pytest.raises(ValueError):
        read_topics(spark, ["a"], path, start="yesterday")
    with pytest.raises(ValueError):
        read_topics(spark, ["a", "b"], path, start={0: 1})
    with pytest.raises(RuntimeError, match="Kafka"):
        read_topics(spark, ["a"])


def test_kafka_options():
    plain = kafka_options({"group.id": "g"})
    assert plain == {
        "kafka.bootstrap.servers": "localhost:9093,localhost:9094,localhost:9095",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
    }
    assert "kafka.sasl.mechanism" not in kafka_options({"username": "u"})
    full = kafka_options({"username": "u", "password": 'p"q', "bootstrap.servers": "h:1", "group.id": "g"})
    assert full["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert full["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert full["kafka.bootstrap.servers"] == "h:1"
    assert 'username="u" password="p\\"q"' in full["kafka.sasl.jaas.config"]
    assert json.loads(topic_log.starting_offsets_json("t", {1: 4, 0: 0})) == {"t": {"0": 0, "1": 4}}
    ranges = offsets.kafka_range_options([("t", 0, 2, 5), ("t", 1, 0, 1)])
    assert json.loads(ranges["startingOffsets"]) == {"t": {"0": 2, "1": 0}}
    assert json.loads(ranges["endingOffsets"]) == {"t": {"0": 5, "1": 1}}


def test_topic_services(spark):
    naming = Naming(namespace="night")
    names = ["ftransfer_ztf_2026-03-23_11487", "fxmatch_x", "night_ztf_20240101", "__consumer_offsets", "rrlyr", "night_in_tns_lsst"]
    df = spark.createDataFrame([(n,) for n in names * 2], "topic string")
    got = {r.topic: r.service for r in topics.topic_catalogue(df, naming=naming).collect()}
    assert got == {
        "ftransfer_ztf_2026-03-23_11487": "datatransfer", "fxmatch_x": "xmatch", "night_ztf_20240101": "stats",
        "rrlyr": "livestream", "night_in_tns_lsst": "livestream"}
    assert topics.topic_catalogue(df, "livestream", naming).count() == 2
    with pytest.raises(ValueError):
        topics.topic_catalogue(df, "radio")
    with pytest.raises(ValueError):
        topics.check_transfer_topic("rrlyr")


def skewed(n, seed=1):
    """Rows of which a third belong to one key, one key being null."""
    rng = random.Random(seed)
    keys = [0] * (n // 3) + [rng.choice([None, *range(1, 20)]) for _ in range(n - n // 3)]
    rng.shuffle(keys)
    return [(k, rng.randrange(1000), i) for i, k in enumerate(keys)]


def test_numbers_are_dense_per_group(spark):
    rows = skewed(3000)
    df = spark.createDataFrame(rows, "k int, t int, i int").repartition(7)
    got = {r.i: r.n for r in numbering.number_rows(df, ["k"], ["t", "i"], "n").collect()}
    expected = {}
    for key in {r[0] for r in rows}:
        mine = sorted((t, i) for k, t, i in rows if k == key)
        expected.update({i: n for n, (_, i) in enumerate(mine)})
    assert got == expected


@pytest.mark.parametrize("hot_rows", [10**6, 64, 11])
def test_history_of_hot_and_cold_keys(spark, hot_rows):
    rows = [(k or 0, t, i) for k, t, i in skewed(1200, 2)]
    df = spark.createDataFrame(rows, "k int, t int, i int").repartition(5)
    out = history.attach_history(df, "k", ["t", "i"], ["i"], 10, "past", hot_rows).collect()
    got = {r.i: None if r.past is None else [p.i for p in r.past] for r in out}
    expected = {}
    for key in {r[0] for r in rows}:
        mine = [i for _, i in sorted((t, i) for k, t, i in rows if k == key)]
        expected.update({i: mine[max(0, n - 10) : n] or None for n, i in enumerate(mine)})
    assert len(out) == len(rows) and got == expected


def test_places_by_blocks_of_offsets(spark):
    """Gaps, block edges, whole and nearly empty blocks: the places of number_rows."""
    rng = random.Random(3)
    rows = []
    for kind, channel in (("a", "x"), ("a", None), ("b", "x")):
        for topic in ("t", "u"):
            for partition in range(2):
                first = rng.choice((0, 7, 32760))
                taken = [o for o in range(first, first + 200) if rng.random() < 0.8] + list(range(65536, 65600)) + [98303, 98304]
                rows += [(kind, channel, topic, partition, o, "wide") for o in taken]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "kind string, channel string, topic string, partition int, offset bigint, body string")
    group, order = ["kind", "channel"], ["topic", "partition", "offset"]
    blocked = numbering.number_in_blocks(df, group, order, "n")
    assert blocked.columns == [*df.columns, "n"]
    plan = blocked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "BroadcastHashJoin" in plan  # the rows stay where they are
    plain = numbering.number_rows(df, group, order, "n")
    assert sorted(map(str, blocked.collect())) == sorted(map(str, plain.collect()))
    assert numbering.number_in_blocks(df.limit(0), group, order, "n").collect() == []
