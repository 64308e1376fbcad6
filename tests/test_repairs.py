"""Cases that once lost or changed data."""

import gzip
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytide.functions import fits
from skytide.operators import archive, cutouts, decode, summary
from skytide.operators.offsets import read_committed
from skytide.plans import derived
from skytide.plans.catalog import topic_config
from skytide.session import scratch_path
from skytide.sources.avro_schema import avro_to_struct_type
from skytide.sources.topic_log import LOG_SCHEMA, read_topics, to_topic_log
from skytide.streaming import live


def alert_log(spark, topics, n):
    rows = spark.range(n * len(topics)).select(
        F.element_at(F.array(*[F.lit(t) for t in topics]), (F.col("id") % len(topics) + 1).cast("int")).alias("topic"),
        F.concat(F.lit("o"), F.col("id")).alias("objectId"), F.col("id").alias("candid"), (F.col("id") + 2460000.5).alias("jd"),
        F.lit(1).alias("fid"), F.lit(17.0).alias("magpsf"),
    )
    path = scratch_path(spark, "repair-log")
    to_topic_log(rows, derived.LIVE_SCHEMA, F.col("topic"), F.lit(0), F.lit("3.0"), ["candid"], F.current_timestamp(), path)
    return path


def job(spark, path, topics, **more):
    return live.LiveJob(
        topics=topics, checkpoint=scratch_path(spark, "cp"), target=avro_to_struct_type(derived.LIVE_SCHEMA), registry=derived.LIVE_REGISTRY,
        log_path=path, **more,
    )


def test_display_shows_every_alert(spark, capsys):
    path = alert_log(spark, ["a"], 50)
    seen = read_topics(spark, ["a"], path)
    alerts = decode.decode_alerts(seen, avro_to_struct_type(derived.LIVE_SCHEMA), derived.LIVE_REGISTRY).select("topic", "alert.objectId")
    summary.print_rows(alerts)
    assert len(capsys.readouterr().out.splitlines()) == 51


def test_a_repeated_run_of_one_topic_replaces_its_outputs(spark, monkeypatch):
    path, runs = alert_log(spark, ["view", "purchase"], 5), scratch_path(spark, "runs")
    outbox = scratch_path(spark, "outbox")
    one, two = (job(spark, path, [t], outbox=outbox, topic_config=topic_config(spark), kinds=["slack"]) for t in ("view", "purchase"))
    monkeypatch.setattr(live, "notification_outbox", lambda alerts, *a, **k: alerts.select("topic", "partition", "offset"))
    monkeypatch.setattr(live, "throttle", lambda messages, *a, **k: messages)
    monkeypatch.setattr(live, "ChannelState", lambda *a: SimpleNamespace(before=lambda batch: None, keep=lambda batch, rows: None))
    real = live.record_run

    def dies(spark_, path_, group, run_id, ranges, done):
        if done:
            raise RuntimeError("died before the commit")
        real(spark_, path_, group, run_id, ranges, done)

    monkeypatch.setattr(live, "record_run", dies)
    with pytest.raises(RuntimeError):
        live.run_limited(spark, one, runs, None)
    monkeypatch.setattr(live, "record_run", real)
    assert live.run_limited(spark, two, runs, None) == 5
    assert live.run_limited(spark, one, runs, None) == 5
    sent = spark.read.parquet(outbox).groupBy("topic").count().collect()
    assert {r.topic: r["count"] for r in sent} == {"view": 5, "purchase": 5}


def test_a_live_query_commits_its_offsets(spark):
    path, runs = alert_log(spark, ["a"], 7), scratch_path(spark, "runs")
    live.start_live(spark, job(spark, path, ["a"], archive=scratch_path(spark, "store"), runs=runs), available_now=True).awaitTermination()
    assert [tuple(r) for r in read_committed(spark, runs, "default").collect()] == [("a", 0, 7)]


def test_missing_ids_do_not_share_a_key(spark):
    rows = [("o", 1, "t", 0, 5), (None, 1, "t", 0, 6), (None, 1, "t", 0, 7), (None, None, "t", 1, 7)]
    frame = spark.createDataFrame(rows, "objectId string, candid long, topic string, partition int, offset long")
    keys = [r[0] for r in frame.select(summary.alert_key(frame, "ztf")).collect()]
    assert keys[0] == "o_1" and len(set(keys)) == 4 and None not in keys
    bare = frame.select("objectId", "candid")
    assert bare.select(summary.alert_key(bare, "ztf")).collect()[1][0] is None


def test_overwrite_keeps_columns_and_null_keys_are_equal(spark, path):
    first = spark.createDataFrame([(1, "x", 1, "p"), (None, "n", 2, "p")], "id long, extra string, v int, day string")
    archive.archive_alerts(first, path, ["id"], "overwrite", ["day"])
    archive.archive_alerts(spark.createDataFrame([(None, 9, "new", "p")], "id long, v long, more string, day string"), path, ["id"], "overwrite", ["day"])
    got = {r.id: (r.extra, r.v, r.more) for r in spark.read.parquet(path).collect()}
    assert got == {1: ("x", 1, None), None: (None, 9, "new")}


def stamp(values, bitpix, cards=("SIMPLE  =                    T",)):
    width = 2
    lines = [*cards, f"BITPIX  = {bitpix:20d}", f"NAXIS   = {2:20d}", f"NAXIS1  = {width:20d}", f"NAXIS2  = {len(values) // width:20d}", "END"]
    head = "".join(line.ljust(80) for line in lines).encode().ljust(2880, b" ")
    return head + np.array(values).astype(fits.PIXEL_TYPES[bitpix]).tobytes().ljust(2880, b"\0")


def test_images_keep_their_precision(spark):
    inf, big = float("inf"), 123456789
    rows = [("double", stamp([inf, 1.0, float("nan"), -inf], -64)), ("single", gzip.compress(stamp([inf, 1.5, 0, 2], -32))), ("int", stamp([big, 1, 2, 3], 32)), ("bare", stamp([1.0, 2.0], -32, ()))]
    frame = spark.createDataFrame(rows, "name string, stamp binary")
    got = {r.name: r for r in cutouts.decode_cutouts(frame, clean=True).collect()}
    top = float(np.finfo(np.float64).max)
    assert list(got["double"].pixels) == [top, 1.0, 0.0, -top]
    assert got["single"].pixels[0] == float(np.finfo(np.float32).max)
    assert got["int"].pixels[0] == big and got["bare"].error is None and list(got["bare"].pixels) == [1.0, 2.0]


def test_schema_of_log_is_unchanged():
    assert LOG_SCHEMA.startswith("key binary, value binary")


def test_paths_without_a_scheme_lie_on_the_default_file_system(spark):
    from skytide import session

    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "hdfs://cluster:8020")
        assert session.qualified(spark, "/data/x") == "hdfs://cluster:8020/data/x"
        assert session.qualified(spark, "s3a://bucket/x") == "s3a://bucket/x"
    finally:
        conf.set("fs.defaultFS", before)
    assert session.qualified(spark, "/data/x") == "/data/x"


def test_an_archive_is_sorted_and_filtered_by_its_lookup_column(spark, path):
    import glob

    import pyarrow.parquet as pq

    rows = spark.range(2000).select(F.concat(F.lit("o"), F.col("id") * 7919 % 2000).alias("objectId"), F.lit("d").alias("day"))
    archive.append_parquet(rows.coalesce(1), path, ["day"], lookup=["objectId"])
    [file] = glob.glob(f"{path}/day=d/*.parquet")
    ids = pq.read_table(file).column("objectId").to_pylist()
    assert ids == sorted(ids)
    assert b"objectId" in open(file, "rb").read()
    assert spark.read.parquet(path).filter("objectId = 'o17'").count() == 1
