import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skytide.operators import offsets
from skytide.session import open_filesystem, scratch_path
from skytide.sources.log_index import index_path, list_parquet, log_bounds, read_index, topic_of
from skytide.sources.log_source import FileRanges, TopicLogReader, admit
from skytide.sources.topic_log import LOG_SCHEMA, latest_positions, offset_bounds, read_topics, starting_offsets_json, write_topic_log
from skytide.streaming.drain import stop_when_drained

TOPICS = ["a b%2F", "plain"]


def add(spark, path, first, n, files=2):
    """n messages to each of three partitions of each topic."""
    rows = [(f"k{o}".encode(), f"{t}{p}:{o}".encode(), t, p, o, None, 0) for t in TOPICS for p in range(3) for o in range(first, first + n)]
    frame = spark.createDataFrame(rows, LOG_SCHEMA).withColumn("timestamp", F.timestamp_seconds(F.col("offset") + 0.25))
    write_topic_log(frame.repartition(files), path)


def as_set(bounds):
    return {tuple(r) for r in bounds.select("topic", "partition", "lo", "hi").collect()}


def test_bounds_come_from_the_index(spark, path):
    add(spark, path, 0, 20)
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    assert as_set(log_bounds(spark, path)) == as_set(offset_bounds(log))
    add(spark, path, 20, 5)
    assert as_set(log_bounds(spark, path, ["plain"])) == {("plain", p, 0, 25) for p in range(3)}
    assert {h.file for h in read_index(path)} == set(list_parquet(path))
    none = offsets.read_committed(spark, scratch_path(spark, "none"), "g")
    plan = offsets.backlog_of_bounds(log_bounds(spark, path), none, TOPICS)._jdf.queryExecution().toString()
    assert "value" not in plan and f"{path}-ranges" in plan.replace("file:", "")


def test_ends_stay_when_files_go(spark, path):
    add(spark, path, 0, 10, files=1)
    before = set(list_parquet(path))
    log_bounds(spark, path)
    add(spark, path, 10, 10, files=1)
    log_bounds(spark, path)
    filesystem, inner = open_filesystem(path)
    for file in before:
        filesystem.delete_file(f"{inner}/{file}")
    assert as_set(log_bounds(spark, path)) == {(t, p, 10, 20) for t in TOPICS for p in range(3)}
    for file in list_parquet(path):
        filesystem.delete_file(f"{inner}/{file}")
    assert as_set(log_bounds(spark, path)) == {(t, p, 20, 20) for t in TOPICS for p in range(3)}


def test_no_log_yet(spark, path):
    assert log_bounds(spark, path).collect() == [] and latest_positions(spark, ["x"], path) == []


@pytest.mark.parametrize("limit", [None, 0, 1, 2, 5, 7, 11, 100])
def test_admission_takes_exactly_the_limit(limit):
    start, ends = {"t": {"0": 4, "1": 0}}, {"t": {"0": 5, "1": 3, "2": 0}, "u": {"0": 7}}
    got = admit(start, ends, limit)
    taken = {(t, p): got[t][p] - start.get(t, {}).get(p, 0) for t in got for p in got[t]}
    assert sum(taken.values()) == min(11, 11 if limit is None else limit)
    assert all(0 <= n and got[t][p] <= max(ends[t][p], start.get(t, {}).get(p, 0)) for (t, p), n in taken.items())


def collected(spark, path, checkpoint, **more):
    """Sizes of the micro-batches, and all messages, of a run up to the present end."""
    sizes, seen = {}, {}

    def keep(batch, batch_id):
        rows = batch.select("topic", "partition", "offset", "key", F.col("value").cast("string"), F.unix_micros("timestamp")).collect()
        sizes[batch_id] = len(rows)
        seen[batch_id] = [tuple(r) for r in rows]

    raw = read_topics(spark, TOPICS, path, True, **more)
    query = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep).start()
    stop_when_drained(query).awaitTermination(120)
    return [sizes[k] for k in sorted(sizes)], [r for k in sorted(seen) for r in seen[k]]


def test_batches_of_n_messages_whatever_the_files(spark, path):
    add(spark, path, 0, 10, files=7)
    checkpoint = scratch_path(spark, "cp")
    sizes, rows = collected(spark, path, checkpoint, per_trigger=17)
    assert sizes == [17, 17, 17, 9]
    expected = [(t, p, o, f"k{o}".encode(), f"{t}{p}:{o}", o * 1000000 + 250000) for t in TOPICS for p in range(3) for o in range(10)]
    assert sorted(rows) == sorted(expected)
    add(spark, path, 10, 2, files=1)  # goes on where it stopped, with another limit
    sizes, rows = collected(spark, path, checkpoint, per_trigger=5)
    assert sizes == [5, 5, 2] and {r[2] for r in rows} == {10, 11}
    assert collected(spark, path, checkpoint, per_trigger=5)[0] == []


def test_start_and_end_offsets(spark, path):
    add(spark, path, 0, 6)
    start = [("plain", 0, 4), ("plain", 1, 6)]
    until = [(t, p, 5) for t in TOPICS for p in range(3)]
    _, rows = collected(spark, path, scratch_path(spark, "cp"), start=start, until=until)
    got = {(t, p): sorted(r[2] for r in rows if r[:2] == (t, p)) for t in TOPICS for p in range(3)}
    assert got[("plain", 0)] == [4] and got[("plain", 1)] == [] and got[("plain", 2)] == got[(TOPICS[0], 0)] == list(range(5))


def test_planner_reads_only_files_of_its_topics_and_ranges(spark, path):
    add(spark, path, 0, 8, files=1)
    add(spark, path, 8, 8, files=1)
    options = {"path": path, "topics": json.dumps(["plain"])}
    reader = TopicLogReader(options, StructType.fromDDL(LOG_SCHEMA))
    assert reader.initialOffset() == {"plain": {"0": 0, "1": 0, "2": 0}} and {topic_of(f) for f in reader.sizes} == {"plain"}
    parts = reader.partitions({"plain": {"0": 9, "1": 16}}, {"plain": {"0": 12, "1": 16}})
    assert [[(t, p, a, b) for _, ranges in part.files for t, p, a, b in ranges] for part in parts] == [[("plain", 0, 9, 12)]]


def test_kafka_options_name_every_partition():
    assert json.loads(starting_offsets_json("t", {1: 5}, 3)) == {"t": {"0": -2, "1": 5, "2": -2}}
    options = offsets.kafka_range_options([("t", 1, 5, 9), ("t", 2, 4, 4)], {"t": 4})
    assert json.loads(options["startingOffsets"]) == {"t": {"0": -2, "1": 5, "2": 4, "3": -2}}
    assert json.loads(options["endingOffsets"]) == {"t": {"0": -1, "1": 9, "2": 4, "3": -1}}


def test_idle_partitions_stay_in_the_plan(spark):
    bounds = spark.createDataFrame([("t", 0, 0, 5), ("t", 1, 3, 3)], "topic string, partition int, lo bigint, hi bigint")
    done = spark.createDataFrame([("t", 1, 3)], "topic string, partition int, committed bigint")
    assert offsets.plan_ranges(bounds, done, 2) == [("t", 0, 0, 2), ("t", 1, 3, 3)]


def test_reading_holds_no_whole_row_group(path):
    """Bodies of one big row group: what a read holds does not grow with it."""
    n = 60_000
    body = np.random.default_rng(1).bytes(500 * n)
    bodies = pa.FixedSizeBinaryArray.from_buffers(pa.binary(500), n, [None, pa.py_buffer(body)]).cast(pa.binary())
    columns = {"key": pa.nulls(n, pa.binary()), "value": bodies, "partition": pa.array([0] * n, pa.int32()), "offset": pa.array(range(n), pa.int64()),
               "timestamp": pa.array([0] * n, pa.timestamp("us")), "timestampType": pa.array([0] * n, pa.int32())}
    filesystem, inner = open_filesystem(path)
    filesystem.create_dir(f"{inner}/topic=plain", recursive=True)
    pq.write_table(pa.table(columns), f"{inner}/topic=plain/one.parquet", row_group_size=n, use_dictionary=False)
    del bodies, columns
    reader = TopicLogReader({"path": path, "topics": json.dumps(["plain"])}, StructType.fromDDL(LOG_SCHEMA))
    held, rows, before = 0, 0, pa.total_allocated_bytes()
    for batch in reader.read(FileRanges([("topic=plain/one.parquet", [("plain", 0, 100, n - 100)])])):
        held, rows = max(held, pa.total_allocated_bytes() - before), rows + batch.num_rows
    assert rows == n - 200
    assert held < 12 << 20  # of 30 MB of bodies
