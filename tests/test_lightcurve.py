import gzip
import math

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from skytide.functions import fits
from skytide.naming import Naming
from skytide.operators import cutouts, lightcurve, outbox, summary
from skytide.session import small_table

ZTF = """objectId string, candid bigint, topic string, cdsxmatch string,
candidate struct<jd:double,fid:int,magpsf:float,sigmapsf:float,diffmaglim:float>,
prv_candidates array<struct<jd:double,fid:int,magpsf:float,sigmapsf:float,diffmaglim:float>>"""
NOW = (2460000.5, 1, 1.0, 0.1, 20.0)


@pytest.fixture
def ztf(spark):
    past = [(2459990.5, 2, 2.0, 0.2, 20.0), (2459991.5, 3, None, None, 19.5), (2459992.5, 1, float("nan"), None, 19.0)]
    return spark.createDataFrame(
        [("A", 1, "t", "Star", NOW, past), ("B", 2, "t", "QSO", NOW, None), ("C", 3, "t", None, NOW, [None, past[0]])], ZTF
    )


def test_current_comes_first(ztf):
    mag = lightcurve.extract_field(ztf, "magpsf", "candidate", "prv_candidates")
    got = {r.objectId: r.m for r in ztf.select("objectId", mag.alias("m")).collect()}
    assert got["A"][:3] == [1.0, 2.0, None] and math.isnan(got["A"][3])
    assert got["B"] == [1.0]
    assert got["C"] == [1.0, None, 2.0]


def test_absent_history_field_is_nulls(ztf):
    absent = lightcurve.extract_history(ztf, "drb", "prv_candidates")
    assert [r.d for r in ztf.orderBy("candid").select(absent.alias("d")).collect()] == [[None] * 3, None, [None] * 2]


def test_long_ztf_light_curve(ztf):
    rows = lightcurve.lightcurve(ztf.filter("objectId = 'A'"), "ztf").orderBy("pos").collect()
    assert [(r.pos, r.band, r.tag, r.y) for r in rows] == [
        (0, "g", "valid", 1.0), (1, "r", "valid", 2.0), (2, None, "upperlim", 19.5), (3, "g", "upperlim", 19.0)]
    assert [r.days_from_last for r in rows] == [8.0, -2.0, -1.0, 0.0]
    assert [r.days_from_first for r in rows] == [0.0, -10.0, -9.0, -8.0]
    assert lightcurve.lightcurve(ztf, "ztf", plotted_only=True).filter("objectId = 'A'").count() == 3
    narrow = lightcurve.lightcurve(ztf, "ztf", fields=["fid"])
    assert narrow.columns == ["objectId", "candid", "pos", "time", "days_from_last", "days_from_first", "fid", "band"]


def test_light_curve_is_a_narrow_plan(ztf, path, spark):
    ztf.write.parquet(path)
    points = lightcurve.lightcurve(spark.read.parquet(path), "ztf", ["objectId"], fields=["fid"])
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "magpsf" not in plan.split("ReadSchema")[1]


def lsst_frame(spark):
    source = "struct<midpointMjdTai:double,psfFlux:double,psfFluxErr:double,band:string,diaObjectId:bigint>"
    past = "array<struct<midpointMjdTai:double,psfFlux:double,psfFluxErr:double,band:string>>"
    rows = [
        (1, "t", (60310.0, 100.0, 1.0, "g", 7), [(60300.0, -5.0, 1.0, "r"), (60301.0, 0.0, 1.0, "q")], (7,), None),
        (2, "t", (60310.0, 100.0, 1.0, "y", None), None, None, ("2024 AB",)),
        (3, "t", (60310.0, 100.0, 1.0, "y", None), None, (None,), ("2024 AB",)),
    ]
    return spark.createDataFrame(
        rows,
        f"diaSourceId bigint, topic string, diaSource {source}, prvDiaSources {past}, "
        "diaObject struct<diaObjectId:bigint>, mpc_orbits struct<designation:string>",
    )


def test_lsst_light_curve_and_summary(spark):
    df = lsst_frame(spark)
    points = lightcurve.lightcurve(df, "lsst", plotted_only=True).filter("diaSourceId = 1").collect()
    assert [(p.band, p.mag) for p in points] == [("g", pytest.approx(26.4))]
    rows = summary.alert_summary(df, "lsst", F.to_timestamp(F.lit("2024-01-02 03:04:05"))).collect()
    assert [(r.id_value, r.id_name) for r in rows] == [
        ("7", "diaObjectId"), ("2024 AB", "SSO desgination"), (None, "diaObjectId")]
    assert rows[0].emitted == "2023-12-31 23:59:23.000" and rows[0].received == "2024-01-02 03:04:05"
    assert summary.alert_summary(df, "lsst").columns == ["emitted", "received", "topic", "id_value", "id_name"]


def test_ztf_summary_and_keys(spark, ztf):
    row = summary.alert_summary(ztf, "ztf").first()
    assert (row.emitted, row.topic, row.objectId, row.cdsxmatch, row.magpsf) == (
        "2023-02-25 00:00:00.000", "t", "A", "Star", 1.0)
    naming = Naming(namespace="night")
    df = spark.createDataFrame(
        [("night_grb_gold", "A", 1, "T9"), ("rrlyr", "A", 1, "T9")], "topic string, objectId string, candid bigint, triggerId string")
    keys = [r.k for r in df.select(summary.alert_key(df, "ztf", naming).alias("k")).collect()]
    assert keys == ["A_T9", "A_1"]
    lsst = lsst_frame(spark)
    assert lsst.select(summary.alert_key(lsst, "lsst").alias("k")).first().k == "1"
    with pytest.raises(ValueError):
        summary.alert_summary(df, "gaia")


def test_object_history_pushes_ids_and_columns_down(spark, path):
    rows = [(o, float(i), i % 3 + 1, 18.0 + i, "valid") for i, o in enumerate(["A", "B", "A", "C"])]
    spark.createDataFrame(rows, "objectId string, jd double, fid int, magpsf double, tag string").write.parquet(path)
    found = lightcurve.object_history(spark, path, ["A", "C"], ["jd", "tag"])
    assert sorted((r.objectId, r.jd) for r in found.collect()) == [("A", 0.0), ("A", 2.0), ("C", 3.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(objectId, [A,C])" in plan and "magpsf" not in plan
    ids = spark.createDataFrame([("B",), ("B",)], "objectId string")
    assert lightcurve.object_history(spark, path, ids, ["jd"]).count() == 1


# -- cutouts ------------------------------------------------------------------
def fits_bytes(pixels, bitpix, **cards):
    lines = ["SIMPLE  =                    T / standard", f"BITPIX  = {bitpix:20d}", "NAXIS   =                    2"]
    lines += [f"NAXIS1  = {pixels.shape[1]:20d}", f"NAXIS2  = {pixels.shape[0]:20d}"]
    lines += [f"{k:8s}= {v:>20}" for k, v in cards.items()] + ["COMMENT no value here"] * 40 + ["END"]
    head = "".join(x.ljust(80) for x in lines).encode()
    head += b" " * (-len(head) % 2880)
    body = pixels.tobytes()
    return head + body + b"\0" * (-len(body) % 2880)


IMAGE = np.arange(63 * 63, dtype=np.float32).reshape(63, 63)


@pytest.fixture
def stamps(spark):
    dirty = IMAGE.copy()
    dirty[0, :3] = [np.nan, np.inf, -np.inf]
    scaled = fits_bytes(np.array([[0, 1, 2], [3, 4, -1]], dtype=">i2"), 16, BSCALE=0.5, BZERO=10, BLANK=-1)
    data = {
        "plain": fits_bytes(IMAGE.astype(">f4"), -32),
        "zipped": gzip.compress(fits_bytes(IMAGE.astype(">f4"), -32)),
        "dirty": gzip.compress(fits.write_image(dirty)),
        "scaled": scaled,
        "corrupt": gzip.compress(fits.write_image(IMAGE))[:200],
        "short": fits.write_image(IMAGE)[:3000],
        "null": None,
    }
    return spark.createDataFrame([Row(name=n, stamp=None if b is None else bytearray(b)) for n, b in data.items()], "name string, stamp binary")


def test_decoded_pixels(stamps):
    rows = {r.name: r for r in cutouts.decode_cutouts(stamps).collect()}
    for name in ("plain", "zipped"):
        assert (rows[name].height, rows[name].width) == (63, 63)
        assert rows[name].pixels == IMAGE.ravel().tolist()
    assert rows["scaled"].height == 2 and rows["scaled"].pixels[:5] == [10.0, 10.5, 11.0, 11.5, 12.0]
    assert math.isnan(rows["scaled"].pixels[5])
    assert rows["corrupt"].pixels is None and rows["corrupt"].error and rows["short"].error
    assert rows["null"].pixels is None and rows["null"].error is None
    with pytest.raises(Exception, match="EOFError|Compressed"):
        cutouts.decode_cutouts(stamps.filter("name = 'corrupt'"), fail_fast=True).collect()


def test_display_form(stamps):
    rows = {r.name: r for r in cutouts.decode_cutouts(stamps, clean=True, display_orientation=True).collect()}
    assert rows["plain"].pixels == IMAGE[::-1].ravel().tolist()
    top = float(np.finfo(np.float32).max)
    assert rows["dirty"].pixels[-63:-60] == [0.0, top, -top]


def test_statistics(stamps):
    rows = {r.name: r for r in cutouts.cutout_stats(stamps).collect()}
    assert (rows["plain"].n_finite, rows["plain"].min, rows["plain"].max) == (3969, 0.0, 3968.0)
    assert rows["plain"].mean == pytest.approx(1984.0)
    assert (rows["dirty"].n_finite, rows["dirty"].min) == (3966, 3.0)
    assert rows["corrupt"].error and rows["null"].n_finite is None


def test_cutout_rows_and_plain_bytes(spark, stamps, path):
    by_name = {r.name: r.stamp for r in stamps.collect()}
    inner = "struct<fileName:string,stampData:binary>"
    df = spark.createDataFrame(
        [("A", 1, ("s", by_name["zipped"]), ("t", by_name["dirty"]), ("d", None))],
        f"objectId string, candid bigint, cutoutScience {inner}, cutoutTemplate {inner}, cutoutDifference {inner}",
    )
    rows = cutouts.cutouts_long(df, "ztf").collect()
    assert [(r.kind, r.stamp) for r in rows] == [("Science", by_name["zipped"]), ("Template", by_name["dirty"]), ("Difference", None)]
    unpacked = cutouts.plain_fits(cutouts.cutouts_long(df, "ztf", kinds=("Science",))).first().fits
    assert bytes(unpacked) == gzip.decompress(bytes(by_name["zipped"]))
    with pytest.raises(ValueError):
        cutouts.cutouts_long(df, "ztf", kinds=("Other",))
    df.write.parquet(path)
    image = cutouts.object_cutout(spark, path, {"objectId": "A"}, "Science", "ztf").first()
    assert image.pixels[:63] == IMAGE[-1].tolist()


# -- outbox -------------------------------------------------------------------
def test_outbox_routes_and_texts(spark, ztf):
    config = small_table(
        spark,
        [
            dict(topic="t", kind="telegram", channel="@c", secret_name="tg"),
            dict(topic="t", kind="slack", channel="", secret_name="sl"),
            dict(topic="u", kind="telegram", channel="@c", secret_name=None),
        ],
        "topic string, kind string, channel string, secret_name string",
    )
    alerts = ztf.unionByName(ztf.filter("objectId = 'A'").withColumn("topic", F.lit("u"))).withColumn(
        "cutoutScience", F.struct(F.lit("f").alias("fileName"), F.lit(b"img").alias("stampData")))
    naming = Naming(portal_host="portal.test")
    box = outbox.notification_outbox(alerts, config, "ztf", ["telegram", "slack"], naming, init_message="hello", extra=["candid"])
    rows = {(r.topic, r.kind, r.object_id): r for r in box.collect()}
    assert len(rows) == 8
    sent = rows["t", "telegram", "A"]
    assert sent.text == "\n*Object ID*: [A](https://ztf.portal.test/A)\n*Topic*: `t`\n    "
    assert rows["t", "slack", "A"].text == "\n*Object ID*: https://ztf.portal.test/A\n*Topic*: `t`\n    "
    assert (sent.route_status, sent.channel, sent.init_message) == ("routed", "@c", "hello")
    assert bytes(sent.cutout) == b"img" and [p.jd for p in sent.lightcurve][0] == NOW[0] and len(sent.lightcurve) == 4
    assert rows["t", "slack", "A"].route_status == "no channel"
    assert rows["u", "telegram", "A"].route_status == "no secret"
    assert rows["u", "slack", "A"].route_status == "no entry for topic"
    assert "token" not in " ".join(box.columns)

    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    timed = outbox.throttle(box, ["topic", "candid"], start).collect()
    when = sorted((r.object_id, str(r.not_before)) for r in timed if r.route_status == "routed")
    assert when == [("A", "2024-01-01 00:00:00"), ("B", "2024-01-01 00:00:10"), ("C", "2024-01-01 00:00:20")]
    assert len(timed) == 8 and all(r.not_before is None for r in timed if r.route_status != "routed")
