import os

import pytest
from pyspark.sql import functions as F

from skytide.naming import Naming
from skytide.operators import archive
from skytide.session import read_table_if_exists, stage, staging_scope

NAMING = Naming(namespace="night")
DATES = ["year", "month", "day"]
JD = 2460311.0  # 2024-01-01 12:00


@pytest.mark.parametrize(
    "ddl, row, survey, by, columns",
    [
        ("jd double", (JD,), "ztf", "time", DATES),
        ("jd double, year string, month string, day string", (JD, "1", "1", "1"), "ztf", "time", DATES),
        ("candidate struct<jd:double>", ((JD,),), "ztf", "time", DATES),
        ("diaSource struct<midpointMjdTai:double>", ((60310.5,),), "lsst", "time", DATES),
        ("x int", (1,), "ztf", "time", []),
        ("nightclass string, jd double", ("SN", JD), "ztf", "nightclass", ["nightclass"]),
        ("jd double", (JD,), "ztf", "nightclass", DATES),
        ("candidate struct<jd:double>", ((JD,),), "ztf", "nightclass", []),
        ("tnsclass string", ("SN Ia",), "ztf", "tnsclass", ["tnsclass"]),
        ("classId int", (3,), "ztf", "classId", ["classId"]),
        ("jd double", (JD,), "ztf", None, []),
    ],
)
def test_partition_columns(spark, ddl, row, survey, by, columns):
    df, got = archive.with_partitions(spark.createDataFrame([row], ddl), by, survey, NAMING)
    assert got == columns
    if columns == DATES:
        assert tuple(df.select(*DATES).first()) == ("2024", "01", "01")
        assert len(df.columns) == len(set(df.columns))


def test_bad_times_have_no_date(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (2460311.5 - 0.2e-3 / 86400,)], "jd double")
    rows = archive.with_partitions(df, "time", "ztf")[0].collect()
    assert [r.day for r in rows] == [None, None, "02"]


def test_argument_checks(spark):
    archive.check_archive_arguments("time", "lsst", "avro", NAMING)
    for bad in [("month", "ztf", "parquet"), ("nightclass", "lsst", "parquet"), ("time", "ztf", "csv"), ("time", "gaia", "avro")]:
        with pytest.raises(ValueError):
            archive.check_archive_arguments(*bad, NAMING)
    with pytest.raises(ValueError):
        archive.with_partitions(spark.range(1), "tnsclass", "ztf", NAMING)


def test_append_keeps_padded_partition_text_and_null_dates(spark, path):
    df = spark.createDataFrame([(1, JD), (2, JD + 40), (3, None)], "id int, jd double")
    parted, columns = archive.with_partitions(df, "time", "ztf")
    archive.append_parquet(parted, path, columns)
    archive.append_parquet(parted, path, columns, gather=True)
    assert os.path.isdir(f"{path}/year=2024/month=01/day=01")
    back = spark.read.parquet(path)
    assert back.count() == 6
    assert {(r.id, r.month) for r in back.collect()} == {(1, "01"), (2, "02"), (3, None)}
    plan = back.filter("month = '02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def stored(spark, path):
    return sorted((r.id, r.v, r.p) for r in spark.read.parquet(path).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, p string, seq int")


def test_store_modes(spark, path):
    archive.archive_alerts(frame(spark, [(1, "a", "x", 0), (2, "a", "x", 0), (3, "a", "y", 0)]), path, ["id"], "error", ["p"])
    with pytest.raises(IOError, match="alert 2 already exists"):
        archive.archive_alerts(frame(spark, [(2, "b", "x", 0), (9, "b", "x", 0)]), path, ["id"], "error", ["p"])
    with pytest.raises(IOError, match="alert 7 already exists"):
        archive.archive_alerts(frame(spark, [(7, "b", "x", 0), (7, "c", "x", 1)]), path, ["id"], "error", ["p"])
    assert len(stored(spark, path)) == 3
    archive.archive_alerts(frame(spark, [(2, "b", "x", 0), (4, "b", "z", 0)]), path, ["id"], "ignore", ["p"], ["seq"])
    assert stored(spark, path) == [(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "b", "z")]
    untouched = os.listdir(f"{path}/p=y")
    archive.archive_alerts(
        frame(spark, [(2, "c", "x", 0), (2, "d", "x", 1), (5, "d", "x", 0)]), path, ["id"], "overwrite", ["p"], ["seq"]
    )
    assert stored(spark, path) == [(1, "a", "x"), (2, "d", "x"), (3, "a", "y"), (4, "b", "z"), (5, "d", "x")]
    assert os.listdir(f"{path}/p=y") == untouched
    # The same input once more changes nothing: a replayed batch is harmless.
    archive.archive_alerts(
        frame(spark, [(2, "c", "x", 0), (2, "d", "x", 1), (5, "d", "x", 0)]), path, ["id"], "overwrite", ["p"], ["seq"]
    )
    assert len(stored(spark, path)) == 5
    with pytest.raises(ValueError, match="another partition"):
        archive.archive_alerts(frame(spark, [(3, "e", "x", 0)]), path, ["id"], "overwrite", ["p"], ["seq"])
    with pytest.raises(ValueError):
        archive.archive_alerts(frame(spark, []), path, ["id"], "merge")


def test_store_without_partitions(spark, path):
    archive.archive_alerts(frame(spark, [(1, "a", "x", 0), (2, "a", "x", 0)]), path, ["id"], "overwrite", order=["seq"])
    archive.archive_alerts(frame(spark, [(2, "b", "x", 0)]), path, ["id"], "overwrite", order=["seq"])
    assert stored(spark, path) == [(1, "a", "x"), (2, "b", "x")]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).select(F.floor(F.col("id") / 5000).alias("key"), F.col("id").alias("seq"))
    last = archive.latest_per_key(df, ["key"], ["seq"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [r.seq for r in last.collect()] == [999]


def test_staged_tables_are_dropped_when_a_scope_ends(spark, path):
    with staging_scope():
        staged = stage(spark.range(5), "scoped")
        name = staged.inputFiles()[0]
        assert staged.count() == 5
        archive.archive_alerts(frame(spark, [(1, "a", "x", 0)]), path, ["id"])  # a scope of its own
        assert os.path.exists(name.removeprefix("file://"))
    assert not os.path.exists(os.path.dirname(name.removeprefix("file://")))
    kept = stage(spark.range(5), "unscoped")
    assert kept.count() == 5
    assert stored(spark, path) == [(1, "a", "x")]


def test_missing_table_is_none(spark, path):
    assert read_table_if_exists(spark, path) is None


@pytest.mark.parametrize("mode", ["overwrite", "ignore", "error"])
def test_trusted_partitions_give_the_same_result(spark, path, mode):
    first = [(1, "a", "x", 0), (2, "a", "x", 0), (3, "a", "y", 0), (4, "a", None, 0)]
    later = [(5, "b", "x", 0)] if mode == "error" else [(2, "b", "x", 0), (4, "b", None, 0), (5, "b", "z", 0)]
    for trust in (False, True):
        target = f"{path}-{trust}"
        archive.archive_alerts(frame(spark, first), target, ["id"], "error", ["p"], ["seq"], trust)
        archive.archive_alerts(frame(spark, later), target, ["id"], mode, ["p"], ["seq"], trust)
        got = sorted(((r.id, r.v, r.p) for r in spark.read.parquet(target).collect()), key=str)
        base = {r[0]: r[:3] for r in first}
        for r in later:
            if mode != "ignore" or r[0] not in base:
                base[r[0]] = r[:3]
        assert got == sorted(base.values(), key=str)
    if mode == "error":
        with pytest.raises(IOError):
            archive.archive_alerts(frame(spark, [(4, "c", None, 0)]), target, ["id"], mode, ["p"], ["seq"], True)


def test_only_touched_folders_are_opened(spark, path, monkeypatch):
    frame(spark, [(i, "a", f"p{i % 5}", 0) for i in range(20)]).write.partitionBy("p").parquet(path)
    rows = frame(spark, [(1, "b", "p1", 0), (2, "b", "p2", 0), (3, "b", None, 0)])
    near = archive._in_partitions_of(spark.read.parquet(path), rows, ["p"])
    by_filter = sorted(r.id for r in near.collect())
    assert by_filter == [i for i in range(20) if i % 5 in (1, 2)]
    plan = near._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "p1" in filters and "p2" in filters
    monkeypatch.setattr(archive, "_MAX_FOLDER_FILTER", 1)
    joined = archive._in_partitions_of(spark.read.parquet(path), rows, ["p"])
    assert sorted(r.id for r in joined.collect()) == by_filter
