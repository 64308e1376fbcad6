import random

import pytest
from pyarrow import fs as pafs

from skytide.operators.archive import days_before, latest_per_key, read_store, settle_store, store_batch
from skytide.operators.outbox import ChannelState
from skytide.operators.settled import batch_folders, drop_settled, read_manifest
from skytide.session import open_filesystem
from pyspark.sql import functions as F

SCHEMA = "k long, o int, v string, year string, month string, day string"


def put(spark, path, batch, rows, **more):
    """Rows of key and value; the day follows from the key."""
    full = [(k, n, v, "2024", "01", None if k % 6 == 5 else f"{k % 6 + 1:02d}") for n, (k, v) in enumerate(rows)]
    store_batch(spark.createDataFrame(full, SCHEMA), path, batch, ["k"], partitions=["year", "month", "day"], **more)


def seen(spark, path, mode="overwrite"):
    rows = read_store(spark, path, ["k"], ["o"], mode).collect()
    assert len({r.k for r in rows}) == len(rows)
    return {r.k: (r.v, r.day) for r in rows}


def settle(spark, path, day, **more):
    return settle_store(spark, path, ["k"], ["o"], days_before(day), **more)


@pytest.mark.parametrize("mode", ["overwrite", "ignore"])
def test_settled_store_reads_like_an_open_one(spark, tmp_path, mode):
    rng, path, plain = random.Random(4), str(tmp_path / "store"), str(tmp_path / "plain")
    for batch in range(7):
        rows = [(rng.randrange(40), f"{batch}.{n}") for n in range(25)]
        for at in (path, plain):
            put(spark, at, batch, rows, mode=mode)
        if batch in (2, 4, 5):
            settle(spark, path, f"2024-01-0{batch}", mode=mode, upto=batch)
            drop_settled(spark, path)
        assert seen(spark, path, mode) == seen(spark, plain, mode)
    assert len(batch_folders(path)) < len(batch_folders(plain))


def test_no_window_over_settled_partitions(spark, path):
    put(spark, path, 0, [(k, "a") for k in range(24)])
    put(spark, path, 1, [(k, "b") for k in range(0, 24, 2)])
    assert settle(spark, path, "2024-01-04") != []  # the newest batch is left
    assert {upto for _, upto in read_manifest(path).values()} == {0}
    settle(spark, path, "2024-01-04", upto=1)
    assert settle(spark, path, "2024-01-04", upto=1) == []  # nothing new to do
    put(spark, path, 2, [(6, "late")])  # day 01
    read = read_store(spark, path, ["k"], ["o"])
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 2 and plan.startswith("Union")
    got = seen(spark, path)
    assert got[6] == ("late", "01") and got[12] == ("b", "01") and got[7] == ("a", "02") and len(got) == 24


def test_rows_without_a_day_stay_open_and_columns_evolve(spark, path):
    put(spark, path, 0, [(5, "x"), (6, "x")])
    settle(spark, path, "2030-01-01", upto=0)
    assert set(read_manifest(path)) == {"year=2024/month=01/day=01"}
    more = spark.createDataFrame([(12, 0, "y", 7, "2024", "01", "01")], "k long, o int, v string, extra int, year string, month string, day string")
    store_batch(more, path, 1, ["k"], partitions=["year", "month", "day"])
    got = {r.k: r.extra for r in read_store(spark, path, ["k"], ["o"]).collect()}
    assert got == {5: None, 6: None, 12: 7}
    settle(spark, path, "2030-01-01", upto=1)
    assert {r.k: r.extra for r in read_store(spark, path, ["k"], ["o"]).collect()} == got


def test_keys_that_move_and_clashes_with_settled_rows(spark, path):
    put(spark, path, 0, [(6, "x")])
    settle(spark, path, "2030-01-01", upto=0)
    with pytest.raises(IOError, match="alert 6 already exists"):
        put(spark, path, 1, [(6, "y")], mode="error")
    put(spark, path, 1, [(7, "y")], mode="error")
    moved = spark.createDataFrame([(7, 0, "z", "2024", "01", "05")], SCHEMA)
    store_batch(moved, path, 2, ["k"], partitions=["year", "month", "day"])
    with pytest.raises(ValueError, match="two partitions"):
        settle(spark, path, "2030-01-01", upto=2)


def test_a_store_without_partitions_or_rows(spark, path):
    with pytest.raises(IOError, match="nothing is stored"):
        read_store(spark, path, ["k"], ["o"])
    frame = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "k long, o int, v string")
    store_batch(frame, path, 0, ["k"])
    assert settle_store(spark, path, ["k"], ["o"], lambda values: True, upto=0) == [""]
    store_batch(frame.filter("o = 0"), path, 1, ["k"])
    assert [r.v for r in read_store(spark, path, ["k"], ["o"]).collect()] == ["a"]


def test_channels_remember_one_row_each(spark, path):
    def messages(rows):
        frame = spark.createDataFrame(rows, "kind string, channel string, s long")
        return frame.withColumn("not_before", F.timestamp_seconds("s"))

    state = ChannelState(spark, path)
    assert state.before(0) is None
    for batch in range(6):
        for _ in range(2):  # a repeated batch begins where it began
            before = state.before(batch)
            assert (before.filter("channel = 'a'").first().last.timestamp() if before else 0) == 10 * batch
            state.keep(batch, messages([("t", "a", 10 * batch + 10), ("t", "a", 3), ("t", f"c{batch}", 1), ("t", "x", None)]))
    assert state.before(9).count() == 7
    filesystem, inner = open_filesystem(path)
    from pyarrow import fs as pafs

    assert sorted(i.base_name for i in filesystem.get_file_info(pafs.FileSelector(inner))) == ["batch=4", "batch=5"]
