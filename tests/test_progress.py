import datetime

import pytest
from pyspark.sql import functions as F

from skytide.operators import offsets
from skytide.session import open_filesystem, scratch_path
from skytide.sources.append_log import AppendLog
from skytide.streaming.progress import _reduce_offsets, per_partition, progress_bounds, offsets_log

SCHEMA = "k string, n bigint"


def last_of_each(rows):
    return list({r["k"]: r for r in rows}.values())


def test_append_log_keeps_a_bounded_number_of_files(spark, path):
    log = AppendLog(path, SCHEMA, last_of_each, tail_files=4)
    assert log.read(spark).collect() == []
    most = 0
    for n in range(60):
        log.append([{"k": f"k{n % 3}", "n": n}, {"k": "all", "n": n}])
        most = max(most, len(log.files()))
    assert most <= 6
    filesystem, inner = open_filesystem(path)
    from pyarrow import fs as pafs

    assert len(filesystem.get_file_info(pafs.FileSelector(inner))) <= 14
    got = {r.k: r.n for r in log.read(spark).groupBy("k").agg(F.max("n").alias("n")).collect()}
    assert got == {"k0": 57, "k1": 58, "k2": 59, "all": 59}


def test_append_log_with_two_writers(spark, path):
    """A file that is written while another writer makes a snapshot is not lost."""
    one, two = (AppendLog(path, SCHEMA, list, tail_files=3) for _ in range(2))
    for n in range(20):
        one.append([{"k": "one", "n": n}])
        late, two._shorten = two._shorten, lambda: None
        two.append([{"k": "two", "n": n}])
        two._shorten = late
    assert sorted((r.k, r.n) for r in one.read(spark).collect()) == sorted([("one", n) for n in range(20)] + [("two", n) for n in range(20)])


def test_committed_offsets_and_open_runs_survive_snapshots(spark, path):
    offsets.record_run(spark, path, "g", "open", [("t", 9, 0, 4)], done=False)
    for n in range(80):
        run = f"r{n}"
        offsets.record_run(spark, path, "g", run, [("t", n % 3, n, n + 1)], done=False)
        offsets.record_run(spark, path, "g", run, [("t", n % 3, n, n + 1)], done=True)
    assert len(offsets.runs_log(spark, path).files()) <= 34
    got = {(r.topic, r.partition): r.committed for r in offsets.read_committed(spark, path, "g").collect()}
    assert got == {("t", 0): 79, ("t", 1): 80, ("t", 2): 78}
    assert offsets.unfinished_run(spark, path, "g", ["t"]) == ("open", [("t", 9, 0, 4)])
    offsets.record_run(spark, path, "g", "open", [("t", 9, 0, 4)], done=True)
    assert offsets.unfinished_run(spark, path, "g", ["t"]) is None


@pytest.mark.parametrize("text, expected", [
    ('{"t": {"0": 5, "1": 7}, "u": {"0": 0}}', {("t", 0): 5, ("t", 1): 7, ("u", 0): 0}),
    ('{"logOffset": 3}', {}), ("None", {}), ("", {}), (None, {}),
])
def test_offsets_of_reports(text, expected):
    assert per_partition(text) == expected


def test_bounds_of_reports(spark, path):
    at = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    rows = [
        dict(query="q", batch=b, at=at + datetime.timedelta(seconds=b), topic="t", partition=p, start=10 * b, end=10 * b + 10, latest=10 * b + 10 + p)
        for b in range(50) for p in range(2)
    ]
    log = offsets_log(spark, path)
    for row in rows:
        log.append([row])
    got = {(r.topic, r.partition): (r.lo, r.hi) for r in progress_bounds(spark, path, ["t"]).collect()}
    assert got == {("t", 0): (0, 500), ("t", 1): (0, 501)} and progress_bounds(spark, path, ["x"]).count() == 0
    assert {(r["partition"], r["start"], r["end"]) for r in _reduce_offsets(rows)} == {(0, 0, 500), (1, 0, 500)}
    plan = progress_bounds(spark, path)._jdf.queryExecution().toString()
    assert "value" not in plan
    none = offsets.read_committed(spark, scratch_path(spark, "none"), "g")
    report = offsets.backlog_of_bounds(progress_bounds(spark, path), none, ["t"]).filter("partition is null").first()
    assert (report.offset, report.lag) == (0, 1001)
