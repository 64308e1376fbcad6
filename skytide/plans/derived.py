"""Alert tables, topic logs and cutouts derived from the star-schema tables.

``events`` stands for measurements, ``embeddings`` for images. Tables that need
a history or encoded messages are written once per session to the scratch
folder and shared by the queries.
"""

from __future__ import annotations

import gzip
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytide.functions import fits, timeconv
from skytide.operators.decode import encode_alerts
from skytide.plans.history import attach_history
from skytide.session import configure, scratch_path, stage
from skytide.sources.topic_log import LOG_SCHEMA, number_messages, offset_bounds, to_topic_log, write_topic_log

HISTORY_DEPTH = 30
PARTITIONS = 4
BULK_TOPIC = "ftransfer_ztf_2024-01-01_1"

_made: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, make):
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time as milliseconds, JD and MJD."""
    raw = table(spark, sf_dir, "events")
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    return raw.withColumn("ms", ms).select(
        "*",
        (F.col("ms") / 86400000 + 2440587.5).alias("jd"),
        (F.col("ms") / 86400000 + 40587.0).alias("mjd"),
    )


# -- alerts -------------------------------------------------------------------
def ztf_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("objectId"),
        e.alias("candid"),
        F.col("event_type").alias("topic"),
        F.col("props").alias("cdsxmatch"),
        "jd",
        (e % 3 + 1).cast("int").alias("fid"),
        F.when(e % 7 != 0, F.col("value")).alias("magpsf"),
        (F.col("value") / 10).alias("sigmapsf"),
        (F.lit(18.0) + e % 5).alias("diffmaglim"),
    )


def ztf_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested ZTF-shaped alerts with up to 30 earlier points of the object."""

    def make():
        fields = ["jd", "fid", "magpsf", "sigmapsf", "diffmaglim"]
        with_past = attach_history(
            ztf_measurements(spark, sf_dir), "objectId", ["jd", "candid"], fields, HISTORY_DEPTH, "prv_candidates"
        )
        nested = with_past.select(
            "objectId", "candid", "topic", "cdsxmatch", F.struct(*fields).alias("candidate"), "prv_candidates"
        )
        return stage(nested, "ztf-alerts")

    return _once(spark, sf_dir, "ztf-alerts", make)


def lsst_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    bands = F.array(*[F.lit(b) for b in ("u", "g", "r", "i", "z", "y")])
    return events(spark, sf_dir).select(
        e.alias("diaSourceId"),
        F.col("event_type").alias("topic"),
        F.col("mjd").alias("midpointMjdTai"),
        (F.col("value") - 50).alias("psfFlux"),
        (F.col("value") / 10).alias("psfFluxErr"),
        F.element_at(bands, (e % 6 + 1).cast("int")).alias("band"),
        u.alias("diaObjectId"),
        F.when(u % 5 != 0, F.struct(u.alias("diaObjectId"))).alias("diaObject"),
        F.when(u % 5 == 0, F.struct(F.concat(F.lit("SSO-"), u.cast("string")).alias("designation"))).alias("mpc_orbits"),
    )


def lsst_nested(measurements: DataFrame, *more) -> DataFrame:
    source = F.struct("midpointMjdTai", "psfFlux", "psfFluxErr", "band", "diaObjectId").alias("diaSource")
    return measurements.select("diaSourceId", "topic", source, "diaObject", "mpc_orbits", *more)


def lsst_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make():
        fields = ["midpointMjdTai", "psfFlux", "psfFluxErr", "band"]
        with_past = attach_history(
            lsst_measurements(spark, sf_dir),
            "diaObjectId",
            ["midpointMjdTai", "diaSourceId"],
            fields,
            HISTORY_DEPTH,
            "prvDiaSources",
        )
        return stage(lsst_nested(with_past, "prvDiaSources"), "lsst-alerts")

    return _once(spark, sf_dir, "lsst-alerts", make)


# -- topic logs ---------------------------------------------------------------
def _record(*fields) -> dict:
    return {"type": "record", "name": "event", "fields": [{"name": n, "type": [t, "null"]} for n, t in fields]}


_FIELDS = [("event_id", "long"), ("ts", "long"), ("user_id", "long"), ("event_type", "string"), ("value", "double")]
EVENT_V1 = _record(*_FIELDS)
EVENT_V2 = _record(*_FIELDS, ("props", "string"))
EVENT_V2_REORDERED = _record(("props", "string"), *_FIELDS)
REGISTRY = {
    "1.0": json.dumps(EVENT_V1),
    "2.0": json.dumps(EVENT_V2),
    "2.0_replayed": json.dumps(EVENT_V2_REORDERED),
    "": json.dumps(EVENT_V2),
}
LIVE_SCHEMA = {
    "type": "record",
    "name": "alert",
    "fields": [
        {"name": "objectId", "type": "string"},
        {"name": "candid", "type": "long"},
        {"name": "jd", "type": "double"},
        {"name": "fid", "type": "int"},
        {"name": "magpsf", "type": ["double", "null"]},
    ],
}
LIVE_REGISTRY = {"3.0": json.dumps(LIVE_SCHEMA)}


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events")
    return raw.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")))


def mixed_log_path(spark: SparkSession, sf_dir: str) -> str:
    """One topic per event type, each announcing its schema in another way:
    the schema itself as key, a version, an old version, a version whose bodies
    are in the replayed field order, and no key at all."""

    def make():
        rows = number_messages(
            event_records(spark, sf_dir), F.col("event_type"), F.col("user_id") % PARTITIONS, ["ts", "event_id"]
        )
        keys = {"view": json.dumps(EVENT_V2), "signup": "2.0", "click": "1.0", "error": "2.0"}
        key = F.lit(None).cast("string")
        for event_type, text in keys.items():
            key = F.when(F.col("event_type") == event_type, F.lit(text)).otherwise(key)
        old, moved = F.col("event_type") == "click", F.col("event_type") == "error"
        encoded = (
            encode_alerts(rows.filter(old), EVENT_V1)
            .unionByName(encode_alerts(rows.filter(moved), EVENT_V2_REORDERED))
            .unionByName(encode_alerts(rows.filter(~old & ~moved), EVENT_V2))
        )
        path = scratch_path(spark, "mixed-log")
        meta = {"key": key.cast("binary"), "timestamp": F.timestamp_micros("ts"), "timestampType": F.lit(0)}
        write_topic_log(encoded.withColumns(meta), path)
        return path

    return _once(spark, sf_dir, "mixed-log", make)


def mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(mixed_log_path(spark, sf_dir))


def live_log_path(spark: SparkSession, sf_dir: str) -> str:
    """Path of a log of flat ZTF-shaped alerts, one topic per event type, half of
    the topics naming the schema version and half carrying the schema itself."""

    def make():
        rows = ztf_measurements(spark, sf_dir)
        path = scratch_path(spark, "live-log")
        key = F.when(F.col("topic").isin("view", "click"), F.lit(json.dumps(LIVE_SCHEMA))).otherwise(F.lit("3.0"))
        partition = F.col("objectId").cast("bigint") % PARTITIONS
        when = timeconv.jd_to_timestamp("jd")
        to_topic_log(rows, LIVE_SCHEMA, F.col("topic"), partition, key, ["jd", "candid"], when, path)
        return path

    return _once(spark, sf_dir, "live-log", make)


def bulk_log(spark: SparkSession, sf_dir: str) -> str:
    """Path of a log with one bulk topic and its schema topic."""

    def make():
        rows, path = event_records(spark, sf_dir), scratch_path(spark, "bulk-log")
        partition, when = F.col("user_id") % PARTITIONS, F.timestamp_micros("ts")
        nothing = F.lit(None).cast("string")
        to_topic_log(rows, EVENT_V2, F.lit(BULK_TOPIC), partition, nothing, ["ts", "event_id"], when, path)
        announced = rows.agg(F.min("ts").alias("ts")).select(
            F.lit(json.dumps(EVENT_V2)).cast("binary").alias("key"),
            F.lit(None).cast("binary").alias("value"),
            F.lit(f"{BULK_TOPIC}_schema").alias("topic"),
            F.lit(0).alias("partition"),
            F.lit(0).cast("bigint").alias("offset"),
            F.timestamp_micros("ts").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
        write_topic_log(announced, path)
        return path

    return _once(spark, sf_dir, "bulk-log", make)


def half_committed(log: DataFrame) -> DataFrame:
    """Half of every partition is committed, but nothing of partition 3."""
    bounds = offset_bounds(log).filter(F.col("partition") != 3)
    return bounds.select("topic", "partition", F.floor(F.col("hi") / 2).alias("committed"))


# -- cutouts ------------------------------------------------------------------
IMAGE_WIDTH = 8


def flawed_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts whose cutouts have dead and saturated pixels: single precision as
    Science, double precision as Template, and that gzip-packed as Difference."""

    def stamps_of(double: bool, packed: bool):
        @F.arrow_udf(T.BinaryType())
        def stamps(ids: pa.Array, values: pa.Array) -> pa.Array:
            out = []
            for vec_id, vector in zip(ids.to_pylist(), values.to_pylist()):
                pixels = np.asarray(vector, np.float64)
                at = np.arange(len(pixels)) + vec_id
                for step, value in ((13, -np.inf), (11, np.inf), (7, np.nan)):
                    pixels[at % step == 0] = value
                body = fits.write_image(pixels.reshape(-1, IMAGE_WIDTH), double)
                out.append(gzip.compress(body, 1) if packed else body)
            return pa.array(out, pa.binary())

        return stamps(F.col("vec_id"), F.col("embedding"))

    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("diaSourceId"),
        stamps_of(False, False).alias("cutoutScience"),
        stamps_of(True, False).alias("cutoutTemplate"),
        stamps_of(True, True).alias("cutoutDifference"),
    )


def image_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts whose Science cutout is the embedding as an image, whose Template
    is the image negated and whose Difference is gzip-packed."""

    @F.arrow_udf(T.BinaryType())
    def to_fits(values: pa.Array) -> pa.Array:
        images = [np.asarray(v, dtype=np.float32).reshape(-1, IMAGE_WIDTH) for v in values.to_pylist()]
        return pa.array([fits.write_image(i) for i in images], pa.binary())

    @F.arrow_udf(T.BinaryType())
    def zipped(stamps: pa.Array) -> pa.Array:
        return pa.array([gzip.compress(b, 1) for b in stamps.to_pylist()], pa.binary())

    vectors = table(spark, sf_dir, "embeddings")
    science = to_fits(F.col("embedding"))
    return vectors.select(
        F.col("vec_id").alias("diaSourceId"),
        "label",
        science.alias("cutoutScience"),
        to_fits(F.transform("embedding", lambda x: -x)).alias("cutoutTemplate"),
        zipped(science).alias("cutoutDifference"),
    )
