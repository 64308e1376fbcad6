"""Named queries over the given tables; each has its SQL twin in ``oracle``."""

from __future__ import annotations

import gzip
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skytide.functions import photometry, text, timeconv
from skytide.naming import MMA_STREAMS, Naming
from skytide.operators import archive, cutouts, decode, lightcurve, offsets, outbox, summary, topics
from skytide.operators.merged import compact_merged, drop_replaced, merge_alerts, read_merged
from skytide.operators.settled import drop_settled
from skytide.plans import derived
from skytide.session import open_filesystem, scratch_path, small_table
from skytide.sources.avro_files import CODECS, list_files, read_alerts, write_avro
from skytide.sources.avro_schema import avro_to_struct_type, struct_type_to_avro, superset
from skytide.sources.object_index import index_objects
from skytide.sources.topic_log import LOG_SCHEMA, read_topics, to_topic_log, write_topic_log
from skytide.streaming.drain import MOVED, TransferJob, drain_topic, transfer_limited
from skytide.streaming.live import LiveJob, start_live, stored_alerts
from skytide.streaming.progress import observed_counts, progress_bounds

EVENT_TYPES = ("view", "signup", "click", "error", "purchase")
NAMING = Naming(namespace="survey", portal_host="portal.example.org")


def _received():
    """A fixed time of receipt, so that results repeat."""
    return F.to_timestamp(F.lit("2024-02-01 12:00:00"))


def _number_or_label(c):
    """Finite values rounded, the rest as text, so that engines agree."""
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(c), "nan")
        .when(c == float("inf"), "inf")
        .when(c == float("-inf"), "-inf")
        .otherwise("finite")
    )


def _finite(c, digits=6):
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.round(c, digits))


# -- projections --------------------------------------------------------------
def detections_per_object(spark, sf_dir):
    """Flagship: dated light-curve points per object, band and tag."""
    alerts, _ = archive.with_partitions(derived.ztf_alerts(spark, sf_dir), "time", "ztf")
    points = lightcurve.lightcurve(
        alerts, "ztf", ["objectId", "month"], plotted_only=True, fields=["fid", "magpsf", "diffmaglim"]
    )
    return points.groupBy("objectId", "month", "band").agg(
        F.count_if(F.col("tag") == "valid").alias("n_detections"),
        F.count_if(F.col("tag") == "upperlim").alias("n_limits"),
        F.max("y").alias("y_max"),
    )


def alert_summary_ztf(spark, sf_dir):
    rows = derived.ztf_measurements(spark, sf_dir)
    nested = rows.select("topic", "objectId", "cdsxmatch", F.struct("jd", "magpsf").alias("candidate"))
    return summary.alert_summary(nested, "ztf", _received())


def alert_summary_lsst(spark, sf_dir):
    rows = derived.lsst_nested(derived.lsst_measurements(spark, sf_dir))
    return summary.alert_summary(rows, "lsst", _received())


def _with_mma_topics(rows: DataFrame) -> DataFrame:
    """Error alerts become multi-messenger ones, on the four fixed topics in turn."""
    names = F.array(*[F.lit(t) for t in NAMING.mma_topics])
    turn = (F.col("candid") % len(MMA_STREAMS) + 1).cast("int")
    return rows.withColumn(
        "topic", F.when(F.col("topic") == "error", F.element_at(names, turn)).otherwise(F.col("topic"))
    ).withColumn("triggerId", F.concat(F.lit("T"), F.col("candid").cast("string")))


def alert_key(spark, sf_dir):
    rows = _with_mma_topics(derived.ztf_measurements(spark, sf_dir))
    return rows.select(
        "candid",
        "topic",
        summary.is_multi_messenger("topic", NAMING).alias("is_mma"),
        summary.alert_key(rows, "ztf", NAMING).alias("alert_key"),
    )


def display_rows(spark, sf_dir):
    """Every alert as the line that is shown for it."""
    rows = derived.ztf_measurements(spark, sf_dir)
    nested = rows.select("topic", "objectId", "cdsxmatch", F.struct("jd", F.round("magpsf", 3).cast("decimal(12,3)").alias("magpsf")).alias("candidate"))
    return summary.display_lines(summary.alert_summary(nested, "ztf", _received()).drop("emitted"))


def missing_ids(spark, sf_dir):
    """Alerts that lack an id are known by their place in the log."""
    rows = derived.ztf_measurements(spark, sf_dir).withColumn("partition", F.lit(1)).withColumn("offset", F.col("candid"))
    lacking = rows.withColumn("objectId", F.when(F.col("candid") % 3 != 0, F.col("objectId")))
    return lacking.select("offset", summary.alert_key(lacking, "ztf").alias("alert_key"))


def poll_rows(spark, sf_dir):
    rows = derived.ztf_measurements(spark, sf_dir).withColumn("roid", F.col("fid"))
    polled = summary.poll_rows(rows, _received())
    return polled.select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "topic", "objectId", "roid")


def topic_catalogue(spark, sf_dir):
    kind = F.col("event_type")
    named = derived.events(spark, sf_dir).select(
        F.when(kind == "view", F.concat(F.lit("ftransfer_"), kind))
        .when(kind == "click", F.concat(F.lit("fxmatch_"), kind))
        .when(kind == "signup", F.concat(F.lit(NAMING.stats_prefix), kind))
        .when(kind == "error", F.lit("__consumer_offsets"))
        .otherwise(kind)
        .alias("topic")
    )
    return topics.topic_catalogue(named, naming=NAMING)


# -- time and partitions ------------------------------------------------------
def date_partitions(spark, sf_dir):
    rows, columns = archive.with_partitions(derived.ztf_measurements(spark, sf_dir), "time", "ztf")
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def date_partitions_nested(spark, sf_dir):
    nested = derived.lsst_nested(derived.lsst_measurements(spark, sf_dir))
    rows, columns = archive.with_partitions(nested, "time", "lsst")
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def partition_fallback(spark, sf_dir):
    """The class strategy with its column, without it, and without any time."""
    rows = derived.ztf_measurements(spark, sf_dir)
    shapes = {
        "class": rows.withColumn(NAMING.class_column, F.col("topic")),
        "date": rows,
        "none": rows.select("objectId", F.struct("jd").alias("candidate")),
    }
    counted = None
    for label, shape in shapes.items():
        parted, columns = archive.with_partitions(shape, NAMING.class_column, "ztf", NAMING)
        value = F.concat_ws("-", *columns) if columns else F.lit("")
        part = parted.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("strategy", F.lit(label))
        counted = part if counted is None else counted.unionByName(part)
    return counted.select("strategy", "value", "n")


def jd_to_mjd(spark, sf_dir):
    rows = derived.events(spark, sf_dir)
    return rows.select("event_id", timeconv.jd_to_mjd("jd").alias("mjd"))


def tai_to_utc(spark, sf_dir):
    """The event time moved back over all leap-second steps, one year per event."""
    rows = derived.events(spark, sf_dir).withColumn("mjd", F.col("mjd") - F.col("event_id") % 60 * 365)
    ts = timeconv.mjd_tai_to_timestamp("mjd")
    return rows.select("event_id", timeconv.iso_millis(ts).alias("utc"))


def _days(spark, sf_dir, relative):
    alerts = derived.ztf_alerts(spark, sf_dir)
    times = lightcurve.extract_field(alerts, "jd", "candidate", "prv_candidates")
    days = alerts.select("candid", relative(times).alias("d"))
    return days.select(
        "candid",
        F.size("d").alias("n"),
        F.array_min("d").alias("d_min"),
        F.array_max("d").alias("d_max"),
        F.element_at("d", 1).alias("d_first"),
    )


def relative_days_last(spark, sf_dir):
    return _days(spark, sf_dir, timeconv.days_from_last)


def relative_days_first(spark, sf_dir):
    return _days(spark, sf_dir, timeconv.days_from_first)


# -- light curves -------------------------------------------------------------
def extract_field(spark, sf_dir):
    alerts = derived.ztf_alerts(spark, sf_dir)
    fid = lightcurve.extract_field(alerts, "fid", "candidate", "prv_candidates")
    mag = lightcurve.extract_field(alerts, "magpsf", "candidate", "prv_candidates")
    absent = lightcurve.extract_history(alerts, "drb", "prv_candidates")
    return alerts.select(
        "candid",
        F.size(fid).alias("n"),
        F.array_join(fid.cast("array<string>"), ",").alias("fids"),
        F.size(F.filter(mag, lambda m: m.isNull())).alias("n_missing"),
        F.coalesce(F.size(absent), F.lit(-1)).alias("n_absent"),
    )


def lightcurve_long(spark, sf_dir):
    points = lightcurve.lightcurve(derived.ztf_alerts(spark, sf_dir), "ztf", plotted_only=True)
    return points.select(
        "candid",
        "objectId",
        "pos",
        "time",
        "days_from_last",
        "band",
        "tag",
        "y",
    )


def lightcurve_lsst(spark, sf_dir):
    stats = lightcurve.band_statistics(derived.lsst_alerts(spark, sf_dir), "lsst")
    return stats.select("diaSourceId", "band", "n_points", "n_shown", F.round("mag_min", 6).alias("mag_min"), F.round("magerr_max", 9).alias("magerr_max"))


def bands_present(spark, sf_dir):
    """All objects, static and moving; each row's own bands first, so that only
    distinct bands of an alert reach the shuffle."""
    alerts = derived.lsst_alerts(spark, sf_dir)
    bands = lightcurve.bands_of(F.col("diaSource.band"), F.col("prvDiaSources.band"))
    rows = alerts.select(summary.lsst_id(alerts)[0].alias("object_id"), F.explode(bands).alias("band"))
    return lightcurve.bands_present(rows, ["object_id"])


def quality_tags(spark, sf_dir):
    rows = derived.ztf_measurements(spark, sf_dir)
    tag = F.when(F.col("magpsf").isNull(), "upperlim").when(F.col("sigmapsf") > 10, "badquality").otherwise("valid")
    points = photometry.quality_points(rows.withColumn("tag", tag))
    return points.select("candid", "tag", "band", "y", "y_err")


def flux_to_mag(spark, sf_dir):
    rows = derived.lsst_measurements(spark, sf_dir)
    mag, err = photometry.flux_to_mag("psfFlux", "psfFluxErr")
    return rows.select("diaSourceId", mag.alias("m"), err.alias("e")).select(
        "diaSourceId",
        _number_or_label(F.col("m")).alias("mag_kind"),
        _finite(F.col("m")).alias("mag"),
        _number_or_label(F.col("e")).alias("magerr_kind"),
        _finite(F.col("e")).alias("magerr"),
        photometry.has_positive_error("e").alias("shown"),
    )


def object_history(spark, sf_dir):
    """History, from the archive, of the objects of customers in debt."""
    path = scratch_path(spark, "object-archive")
    rows, columns = archive.with_partitions(derived.ztf_measurements(spark, sf_dir), "time", "ztf")
    archive.append_parquet(rows, path, columns, lookup=["objectId"])
    ids = derived.table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").cast("string").alias("objectId")
    )
    found = lightcurve.object_history(spark, path, ids, ["jd", "fid", "magpsf", "sigmapsf", "diffmaglim"])
    return found.select(
        "objectId",
        "jd",
        "fid",
        "magpsf",
        "sigmapsf",
        "diffmaglim",
    )


def indexed_history(spark, sf_dir):
    """The same through an index of objects to files, some files being newer than it."""
    path = scratch_path(spark, "indexed-archive")
    rows, columns = archive.with_partitions(derived.ztf_measurements(spark, sf_dir), "time", "ztf")
    late = F.col("day") > "20"
    archive.append_parquet(rows.filter(~late), path, columns, gather=True, lookup=["objectId"])
    index_objects(spark, path, "objectId")
    archive.append_parquet(rows.filter(late), path, columns, gather=True, lookup=["objectId"])
    ids = derived.table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("objectId"))
    return lightcurve.object_history(spark, path, ids, ["jd", "fid", "magpsf", "sigmapsf", "diffmaglim"])


# -- text ---------------------------------------------------------------------
def legal_topic_name(spark, sf_dir):
    rows = derived.table(spark, sf_dir, "documents")
    name = F.concat_ws(" ", "source", "lang")
    return rows.select("doc_id", text.legal_topic_name(name).alias("topic"))


def legal_topic_text(spark, sf_dir):
    rows = derived.table(spark, sf_dir, "documents")
    return rows.select("doc_id", text.legal_topic_name("text").alias("letters"))


def markdown_escape(spark, sf_dir):
    rows = derived.table(spark, sf_dir, "documents")
    return rows.select("doc_id", text.escape_markdown("text").alias("escaped"))


def tag_topic_name(spark, sf_dir):
    rows = derived.table(spark, sf_dir, "documents")
    return rows.select(text.tag_topic_name("source", NAMING).alias("topic")).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n")
    )


# -- offsets ------------------------------------------------------------------
def _log_and_committed(spark, sf_dir):
    log = derived.mixed_log(spark, sf_dir)
    return log, derived.half_committed(log)


def topic_log(spark, sf_dir):
    log = derived.mixed_log(spark, sf_dir)
    return log.select(
        "topic", "partition", "offset", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp")
    )


def offset_lag(spark, sf_dir):
    return offsets.offset_lag(*_log_and_committed(spark, sf_dir))


def offset_totals(spark, sf_dir):
    return offsets.offset_totals(offsets.offset_lag(*_log_and_committed(spark, sf_dir)))


def nonempty_partitions(spark, sf_dir):
    """Five partitions per topic are known, the last of which holds nothing."""
    log, committed = _log_and_committed(spark, sf_dir)
    known = log.select("topic").distinct().withColumn("partition", F.explode(F.sequence(F.lit(0), F.lit(4))))
    return offsets.nonempty_partitions(offsets.offset_lag(log, committed, known)).select("topic", "partition", "lag")


def last_offsets(spark, sf_dir):
    log, committed = _log_and_committed(spark, sf_dir)
    return offsets.last_offsets(log.select("topic", "partition").distinct(), committed)


def partition_counts(spark, sf_dir):
    log = derived.mixed_log(spark, sf_dir)
    asked = log.select("topic").distinct().unionByName(
        derived.table(spark, sf_dir, "region").select(F.col("r_name").alias("topic"))
    )
    return offsets.partition_counts(log, asked)


def partition_sizes(spark, sf_dir):
    return offsets.partition_sizes(derived.mixed_log(spark, sf_dir))


def backlog_report(spark, sf_dir):
    log, committed = _log_and_committed(spark, sf_dir)
    return offsets.backlog_report(log, committed, ["view", "click"])


def one_message(spark, sf_dir):
    """The next message of each topic after what is committed, and none of an unknown topic."""
    log, committed = _log_and_committed(spark, sf_dir)
    out = None
    for asked in [*EVENT_TYPES, "nothing"]:
        mine = F.col("topic") == asked
        one = offsets.next_message(log.filter(mine), committed.filter(mine)).select(F.lit(asked).alias("asked"), "topic", "partition", "offset")
        out = one if out is None else out.unionByName(one)
    return out


def start_offsets(spark, sf_dir):
    """What a reader that asks for the given start offsets sees of one topic."""
    path = derived.mixed_log_path(spark, sf_dir)
    seen = read_topics(spark, ["view"], path, start={p: 10 * (p + 1) for p in range(derived.PARTITIONS)})
    return seen.select("topic", "partition", "offset")


def partial_start_offsets(spark, sf_dir):
    """Partitions without a start offset of their own are read from the beginning."""
    seen = read_topics(spark, ["view"], derived.mixed_log_path(spark, sf_dir), start={0: 5})
    return seen.select("topic", "partition", "offset")


# -- codec --------------------------------------------------------------------
def _plain(df: DataFrame) -> DataFrame:
    return df.select("event_id", "ts", "user_id", "event_type", "value", "props")


def avro_roundtrip(spark, sf_dir):
    """Nested alerts with their history arrays, encoded and decoded."""
    alerts = derived.ztf_alerts(spark, sf_dir)
    schema = struct_type_to_avro(alerts.schema)
    bodies = decode.encode_alerts(alerts, schema).select(F.lit(None).cast("binary").alias("key"), "value")
    back = decode.decode_alerts(bodies, avro_to_struct_type(schema), override=schema).select("alert.*")
    return back.select(
        "objectId",
        "candid",
        "topic",
        "cdsxmatch",
        "candidate.jd",
        "candidate.magpsf",
        F.coalesce(F.size("prv_candidates"), F.lit(0)).alias("n_history"),
        F.array_join(F.col("prv_candidates.fid").cast("array<string>"), ",").alias("history_fids"),
    )


def avro_files_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "avro-files")
    write_avro(derived.event_records(spark, sf_dir), path, derived.EVENT_V2, compression="deflate")
    return _plain(read_alerts(spark, path))


def avro_files_union(spark, sf_dir):
    """A folder with files of two schema versions, merged by name."""
    path, rows = scratch_path(spark, "avro-mixed"), derived.event_records(spark, sf_dir)
    old = F.col("event_type") == "click"
    write_avro(rows.filter(old).drop("props"), path, derived.EVENT_V1, mode="append")
    write_avro(rows.filter(~old), path, derived.EVENT_V2_REORDERED, mode="append")
    return _plain(read_alerts(spark, path))


def avro_codecs(spark, sf_dir):
    """Files of every block codec and of different folders, read as one list."""
    rows, paths = derived.event_records(spark, sf_dir), []
    for k, codec in enumerate(CODECS):
        paths.append(scratch_path(spark, f"avro-{codec}"))
        write_avro(rows.filter(F.col("event_id") % len(CODECS) == k), paths[-1], derived.EVENT_V2, compression=codec)
    return _plain(read_alerts(spark, paths))


def gzip_files(spark, sf_dir):
    """Container files packed whole with gzip, read back as a folder."""
    plain, packed = scratch_path(spark, "avro-plain"), scratch_path(spark, "avro-gzip")
    write_avro(derived.event_records(spark, sf_dir), plain, derived.EVENT_V2)

    def pack(batches):
        filesystem, inner = open_filesystem(packed)
        filesystem.create_dir(inner, recursive=True)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                with filesystem.open_output_stream(f"{inner}/{name.rpartition('/')[2]}.gz", compression=None) as out:
                    out.write(gzip.compress(body.as_py(), 1))
            yield batch.select([0])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.avro").load(plain)
    files.select("path", "content").mapInArrow(pack, "path string").count()
    return _plain(read_alerts(spark, packed))


def first_records(spark, sf_dir):
    """The first third of the records of a list of files, in the list's order."""
    rows, paths = derived.event_records(spark, sf_dir), []
    for kind in EVENT_TYPES:
        paths.append(scratch_path(spark, f"avro-{kind}"))
        one = rows.filter(F.col("event_type") == kind).coalesce(1).sortWithinPartitions("event_id")  # one file
        write_avro(one, paths[-1], derived.EVENT_V2)
    files = [f for path in paths for f, _ in list_files(path)]
    return read_alerts(spark, files, size=rows.count() // 3).select("event_id", "event_type")


def many_versions(spark, sf_dir):
    """A hundred files, the newer version first in the list: the version listed last gives the type."""
    rows, parts = derived.event_records(spark, sf_dir), []
    record = {"type": "record", "name": "labelled", "fields": [{"name": "label", "type": "string"}]}
    newer = {**derived.EVENT_V1, "fields": [f if f["name"] != "value" else {"name": "value", "type": [record, "null"]} for f in derived.EVENT_V1["fields"]]}
    old = F.col("event_id") % 2 == 0
    for label, kept, schema in (("z-old", rows.filter(old), derived.EVENT_V1), ("a-new", rows.filter(~old).withColumn("value", F.struct(F.col("event_type").alias("label"))), newer)):
        path = scratch_path(spark, label)
        write_avro(kept.drop("props").repartition(50), path, schema)
        parts += [f for f, _ in list_files(path)]
    read = read_alerts(spark, parts)
    return read.select("event_id", F.col("value.label").alias("label"), F.round("value_legacy", 6).alias("value_legacy"))


def encode_missing_fields(spark, sf_dir):
    """Optional fields the rows lack altogether, an array and a record among them, are encoded as null."""
    fields = [*derived.EVENT_V1["fields"], {"name": "tags", "type": [{"type": "array", "items": "string"}, "null"]},
              {"name": "more", "type": ["null", {"type": "record", "name": "more", "fields": [{"name": "x", "type": "int"}]}]}]
    schema = json.dumps({**derived.EVENT_V1, "fields": fields})
    bodies = decode.encode_alerts(derived.event_records(spark, sf_dir).drop("props"), schema)
    back = decode.decode_alerts(bodies.select(F.lit(None).cast("binary").alias("key"), "value"), avro_to_struct_type(schema), override=schema)
    return back.select("alert.event_id", F.col("alert.tags").isNull().alias("no_tags"), F.col("alert.more").isNull().alias("no_more"))


def wider_schema(spark, sf_dir):
    """Messages whose own schema has a field the target lacks: decoded, and the field is named."""
    decoded = decode.decode_alerts(derived.mixed_log(spark, sf_dir), avro_to_struct_type(json.dumps(derived.EVENT_V1)), derived.REGISTRY)
    return decoded.select("topic", "partition", "offset", F.array_join("dropped_fields", ",").alias("dropped"))


def poison_keys(spark, sf_dir):
    """Keys that are no JSON, no record, or of a type no reader knows: one error a
    message, all others decoded."""
    bad = F.element_at(
        F.array(*[F.lit(t) for t in ("{not json", '{"type": "map", "values": "int"}', '{"type": "record", "name": "r", "fields": [{"name": "f", "type": {"type": "fixed", "size": 4, "name": "q"}}]}')]),
        (F.col("offset") % 3 + 1).cast("int"),
    )
    log = derived.mixed_log(spark, sf_dir)
    poisoned = log.withColumn("key", F.when(F.col("topic") == "view", bad.cast("binary")).otherwise(F.col("key")))
    decoded = decode.decode_alerts(poisoned, superset([derived.EVENT_V1, derived.EVENT_V2]), derived.REGISTRY, mode="PERMISSIVE")
    return decoded.select("topic", "partition", "offset", F.col("error").isNotNull().alias("failed"), F.col("alert.event_id"))


def _decoded_log(spark, sf_dir):
    target = superset([derived.EVENT_V1, derived.EVENT_V2])
    return decode.decode_alerts(derived.mixed_log(spark, sf_dir), target, derived.REGISTRY)


def multi_schema_union(spark, sf_dir):
    return _decoded_log(spark, sf_dir).select(
        "topic", "partition", "offset", "replayed", *[F.col("alert")[c].alias(c) for c in ("event_id", "value", "props")]
    )


def dead_letters(spark, sf_dir):
    """Messages no known schema fits: an unregistered version, a field order that
    was never registered, a missing key."""
    target = superset([derived.EVENT_V1, derived.EVENT_V2])
    only = {"2.0": derived.REGISTRY["2.0"]}
    decoded = decode.decode_alerts(derived.mixed_log(spark, sf_dir), target, only, mode="PERMISSIVE")
    return decoded.filter(F.col("error").isNotNull()).select(
        "topic", "partition", "offset", "schema_id", F.col("alert").isNull().alias("no_alert"),
        F.col("error").startswith("unknown").alias("unknown_schema"),
    )


def schema_table(spark, sf_dir):
    """Schemas seen in the keys of the log, with how often each topic used one."""
    log = derived.mixed_log(spark, sf_dir)
    seen = decode.schema_table(log)
    used = decode.resolve_schemas(log).groupBy("topic", "schema_id").agg(F.count(F.lit(1)).alias("n"))
    return seen.join(used, ["topic", "schema_id"]).select(
        "topic", F.get_json_object("schema_json", "$.name").alias("schema_name"), "n"
    )


# -- transfer -----------------------------------------------------------------
def _job(spark, sf_dir, **more) -> TransferJob:
    return TransferJob(
        topic=derived.BULK_TOPIC,
        archive=scratch_path(spark, "archive"),
        checkpoints=scratch_path(spark, "checkpoints"),
        log_path=derived.bulk_log(spark, sf_dir),
        **more,
    )


def drain_archive(spark, sf_dir):
    """Streaming drain of the bulk topic into an archive, read back."""
    job = _job(spark, sf_dir, partition_by=None)
    drain_topic(spark, job, max_idle=1)
    return _plain(spark.read.parquet(job.output))


def drain_resume(spark, sf_dir):
    """Drain in small batches and again with nothing new, then from the start
    under a new generation: each generation holds every message once."""
    job = _job(spark, sf_dir, partition_by=None, with_offsets=True, per_trigger=1 + _half(spark, sf_dir) // 2)
    drain_topic(spark, job, max_idle=2)
    again = TransferJob(**{**job.__dict__, "generation": 1, "per_trigger": None})
    drain_topic(spark, again, max_idle=1)
    both = spark.read.parquet(job.output).unionByName(spark.read.parquet(again.output))
    return (
        both.groupBy("partition")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("offset").alias("n_offsets"),
            F.max("offset").alias("last_offset"),
            F.round(F.sum("value"), 2).alias("total_value"),
        )
    )


def drain_avro(spark, sf_dir):
    """Several micro-batches into Avro folders, read back as one archive."""
    job = _job(spark, sf_dir, partition_by=None, out_format="avro", per_trigger=1 + _half(spark, sf_dir) // 2)
    drain_topic(spark, job, max_idle=1)
    return _plain(read_alerts(spark, job.output))


def _half(spark, sf_dir) -> int:
    return derived.table(spark, sf_dir, "events").count() // 2


def bounded_limit(spark, sf_dir):
    """Half of the topic in one bounded run."""
    job = _job(spark, sf_dir, partition_by=None, with_offsets=True)
    transfer_limited(spark, job, scratch_path(spark, "committed"), _half(spark, sf_dir))
    return spark.read.parquet(job.output).select("partition", "offset", "event_id")


def bounded_resume(spark, sf_dir):
    """Two runs of a quarter each equal one run of a half."""
    job = _job(spark, sf_dir, partition_by=None, with_offsets=True)
    committed, half = scratch_path(spark, "committed"), _half(spark, sf_dir)
    transfer_limited(spark, job, committed, half // 2)
    transfer_limited(spark, job, committed, half - half // 2)
    return spark.read.parquet(job.output).select("partition", "offset", "event_id")


def backlog_after_drain(spark, sf_dir):
    """A drain commits what it moved: nothing is left to read."""
    job, runs = _job(spark, sf_dir, partition_by=None), scratch_path(spark, "runs")
    drain_topic(spark, job, max_idle=1, runs_path=runs)
    log = read_topics(spark, [job.topic], job.log_path)
    return offsets.backlog_report(log, offsets.read_committed(spark, runs, job.run_group), [job.topic])


def backlog_from_progress(spark, sf_dir):
    """A backlog from the ends a drain has reported, with half of three partitions
    committed: no message is read for it."""
    job = _job(spark, sf_dir, partition_by=None, per_trigger=1 + _half(spark, sf_dir) // 2, progress=scratch_path(spark, "progress"))
    drain_topic(spark, job, max_idle=1)
    bounds = progress_bounds(spark, job.progress, [job.topic])
    committed = bounds.filter("partition <> 3").select("topic", "partition", F.floor(F.col("hi") / 2).alias("committed"))
    return offsets.backlog_of_bounds(bounds, committed, [job.topic])


def transfer_progress(spark, sf_dir):
    """What a drain in batches of N messages has observed of its batches, and what it returns."""
    job = _job(spark, sf_dir, partition_by=None, per_trigger=1 + _half(spark, sf_dir) // 2, progress=scratch_path(spark, "progress"))
    moved = drain_topic(spark, job, max_idle=1)
    counts = observed_counts(spark, job.progress).filter((F.col("name") == MOVED) & (F.col("metric") == "messages"))
    return counts.agg(
        F.count(F.lit(1)).alias("n_batches"), F.max("value").cast("bigint").alias("largest"),
        F.sum("value").cast("bigint").alias("n_messages"), F.lit(moved).cast("bigint").alias("returned"),
    )


def backlog_after_live(spark, sf_dir):
    """Every micro-batch of a live query commits its offsets."""
    job = _live_job(spark, sf_dir, log_path=derived.live_log_path(spark, sf_dir), runs=scratch_path(spark, "runs"))
    start_live(spark, job, available_now=True).awaitTermination()
    log = read_topics(spark, job.topics, job.log_path)
    return offsets.offset_totals(offsets.offset_lag(log, offsets.read_committed(spark, job.runs, job.group)))


def limited_generation(spark, sf_dir):
    """A bounded run of everything, then the same as a new generation: all messages again."""
    job = _job(spark, sf_dir, partition_by=None, with_offsets=True)
    committed = scratch_path(spark, "committed")
    transfer_limited(spark, job, committed, None)
    again = TransferJob(**{**job.__dict__, "generation": 1})
    transfer_limited(spark, again, committed, None)
    return spark.read.parquet(again.output).select("partition", "offset", "event_id")


def _live_job(spark, sf_dir, **more) -> LiveJob:
    return LiveJob(
        topics=list(EVENT_TYPES),
        checkpoint=scratch_path(spark, "live-checkpoint"),
        target=avro_to_struct_type(derived.LIVE_SCHEMA),
        registry=derived.LIVE_REGISTRY,
        archive=scratch_path(spark, "live-archive"),
        **more,
    )


def _log_in_two_parts(spark, sf_dir):
    """A log holding every other message, and the messages it lacks."""
    path = scratch_path(spark, "log")
    log = spark.read.schema(LOG_SCHEMA).parquet(derived.live_log_path(spark, sf_dir)).withColumn("old", F.col("offset") % 2 == 0)
    before = log.groupBy("topic", "partition").agg(F.count_if("old").alias("n"))
    log = log.withColumn("offset", F.floor(F.col("offset") / 2))
    write_topic_log(log.filter("old"), path)
    later = log.filter("not old").join(before, ["topic", "partition"]).withColumn("offset", F.col("offset") + F.col("n"))
    return path, later


def restart_latest(spark, sf_dir):
    """A query that starts at the latest message, stops, and starts again: what
    came while it was down is delivered, what was there before is not."""
    path, later = _log_in_two_parts(spark, sf_dir)
    job = _live_job(spark, sf_dir, log_path=path, start="latest")
    start_live(spark, job, available_now=True).awaitTermination()
    write_topic_log(later, path)
    start_live(spark, job, available_now=True).awaitTermination()
    return stored_alerts(spark, job).select("topic", "partition", "alert_key")


def idle_poll(spark, sf_dir):
    """A query that polls: it finds nothing for some polls, then what has come meanwhile."""
    path, later = _log_in_two_parts(spark, sf_dir)
    query = start_live(spark, job := _live_job(spark, sf_dir, log_path=path, poll_seconds=0.25))
    try:
        query.processAllAvailable()
        query.awaitTermination(1)
        write_topic_log(later, path)
        query.processAllAvailable()
    finally:
        query.stop()
    return stored_alerts(spark, job).select("topic", "partition", "alert_key")


def live_stream(spark, sf_dir):
    """The live query over all topics: keyed archive of the decoded alerts."""
    job = _live_job(spark, sf_dir, log_path=derived.live_log_path(spark, sf_dir))
    start_live(spark, job, available_now=True).awaitTermination()
    return stored_alerts(spark, job).select("topic", "partition", "alert_key", "magpsf")


# -- keyed archive ------------------------------------------------------------
def _two_versions(spark, sf_dir, mode):
    """Archive all but signups, then signups and revised purchases."""
    rows, columns = archive.with_partitions(derived.ztf_measurements(spark, sf_dir), "time", "ztf")
    path = scratch_path(spark, f"store-{mode}")
    archive.archive_alerts(rows.filter("topic <> 'signup'"), path, ["candid"], "error", columns, ["jd"])
    revised = rows.filter("topic in ('signup', 'purchase')").withColumn("magpsf", F.col("magpsf") + 1)
    archive.archive_alerts(revised, path, ["candid"], mode, columns, ["jd"])
    return spark.read.parquet(path).select("candid", "topic", "magpsf", "month", "day")


def archive_merge(spark, sf_dir):
    """Revised alerts merged into an archive without partitions, then part of it compacted."""
    rows, path = derived.ztf_measurements(spark, sf_dir), scratch_path(spark, "merged")
    dated, _ = archive.with_partitions(rows, "time", "ztf")
    merge_alerts(dated.filter("topic <> 'signup'"), path, ["candid"], "error")
    revised = dated.filter("topic in ('signup', 'purchase')")
    merge_alerts(revised.withColumn("magpsf", F.col("magpsf") + 9), path, ["candid"], "overwrite")
    merge_alerts(revised.withColumn("magpsf", F.col("magpsf") + 1), path, ["candid"], "overwrite")
    compact_merged(spark, path, replaced=0.9, small_rows=0)
    drop_replaced(spark, path)
    merge_alerts(dated, path, ["candid"], "ignore")
    return read_merged(spark, path).select("candid", "topic", "magpsf", "month", "day")


def archive_overwrite(spark, sf_dir):
    return _two_versions(spark, sf_dir, "overwrite")


def archive_evolved_schema(spark, sf_dir):
    """An overwrite by rows with one column less and one more: no column is lost."""
    rows, columns = archive.with_partitions(derived.ztf_measurements(spark, sf_dir), "time", "ztf")
    path = scratch_path(spark, "store-evolved")
    archive.archive_alerts(rows.withColumn("fid", F.col("fid").cast("int")), path, ["candid"], "overwrite", columns, ["jd"])
    revised = rows.filter("topic = 'signup'").drop("diffmaglim").withColumn("note", F.lit("revised")).withColumn("fid", F.col("fid").cast("bigint"))
    archive.archive_alerts(revised, path, ["candid"], "overwrite", columns, ["jd"])
    return spark.read.option("mergeSchema", True).parquet(path).filter("month is not null").select("candid", F.col("fid").cast("bigint").alias("fid"), "diffmaglim", "note")


def archive_ignore(spark, sf_dir):
    return _two_versions(spark, sf_dir, "ignore")


def latest_per_object(spark, sf_dir):
    """Several versions of one key in the input: the last one counts."""
    rows = derived.ztf_measurements(spark, sf_dir)
    return archive.latest_per_key(rows, ["objectId"], ["jd", "candid"]).select("objectId", "candid", "topic")


def settled_store(spark, sf_dir):
    """A store of several batches: days settled, a settled day reopened by late rows,
    settled again, and later rows still open."""
    rows, columns = archive.with_partitions(derived.ztf_measurements(spark, sf_dir), "time", "ztf")
    path, key, order = scratch_path(spark, "settled-store"), ["candid"], ["jd"]

    def add(batch, kinds, change):
        revised = rows.filter(F.col("topic").isin(*kinds)).withColumn("magpsf", F.col("magpsf") + change)
        archive.store_batch(revised, path, batch, key, partitions=columns)

    add(0, [k for k in EVENT_TYPES if k != "signup"], 0)
    add(1, ["purchase"], 1)
    archive.settle_store(spark, path, key, order, archive.days_before("2024-01-11"), upto=1)
    add(2, ["signup", "click"], 2)
    archive.settle_store(spark, path, key, order, archive.days_before("2024-01-21"), upto=2)
    drop_settled(spark, path)
    add(3, ["error"], 3)
    return archive.read_store(spark, path, key, order).select("candid", "topic", "magpsf", "month", "day")


# -- cutouts ------------------------------------------------------------------
def cleaned_images(spark, sf_dir):
    """Images with NaN and infinite pixels, of single and double precision, made ready to show."""
    long = cutouts.cutouts_long(derived.flawed_images(spark, sf_dir), "lsst")
    images = cutouts.decode_cutouts(long, clean=True)
    top, bottom = F.array_max("pixels"), F.array_min("pixels")
    usual = F.filter("pixels", lambda x: F.abs(x) < 1e30)
    return images.select(
        "diaSourceId", "kind", top.alias("top"), bottom.alias("bottom"),
        F.size(F.filter("pixels", lambda x: x == 0)).alias("n_zero"),
        F.round(F.aggregate(usual, F.lit(0.0), lambda total, x: total + x), 5).alias("total"),
    )


def cutout_stats(spark, sf_dir):
    long = cutouts.cutouts_long(derived.image_alerts(spark, sf_dir), "lsst")
    stats = cutouts.cutout_stats(long)
    return stats.select(
        "diaSourceId",
        "kind",
        "height",
        "width",
        "n_finite",
        F.round("min", 6).alias("min"),
        F.round("max", 6).alias("max"),
        F.round("mean", 6).alias("mean"),
    )


def cutouts_long(spark, sf_dir):
    """Display-oriented pixels, one row per image row."""
    long = cutouts.cutouts_long(derived.image_alerts(spark, sf_dir), "lsst")
    images = cutouts.decode_cutouts(long, clean=True, display_orientation=True)
    # A row of pixels is a slice of its image's array: no pixel becomes a row.
    y = F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y")
    rows = images.select("diaSourceId", "kind", "width", "pixels", y)
    line = F.slice("pixels", F.col("y") * F.col("width") + 1, F.col("width"))
    return rows.select(
        "diaSourceId", "kind", F.col("y").cast("bigint").alias("y"),
        F.round(F.aggregate(line, F.lit(0.0), lambda total, x: total + x), 5).alias("row_sum"),
        F.round(F.array_max(line), 6).alias("row_max"),
    )


def plain_fits(spark, sf_dir):
    plain = cutouts.plain_fits(cutouts.cutouts_long(derived.image_alerts(spark, sf_dir), "lsst"))
    return plain.select("diaSourceId", "kind", F.length("fits").alias("n_bytes"), F.substring("fits", 1, 6).cast("string").alias("head"))


def object_cutout(spark, sf_dir):
    """Science cutouts of the archived alerts with one label."""
    path = scratch_path(spark, "cutout-archive")
    archive.append_parquet(derived.image_alerts(spark, sf_dir), path, ["label"])
    found = cutouts.object_cutout(spark, path, {"label": 1}, "Science", "lsst")
    top = F.slice("pixels", 1, F.col("width"))
    total = F.aggregate(top, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return found.select("diaSourceId", "height", F.round(total, 5).alias("top_row_sum"))


# -- notifications ------------------------------------------------------------
def topic_config(spark: SparkSession) -> DataFrame:
    rows = [
        dict(topic="view", kind="telegram", channel="@views", secret_name="tg"),
        dict(topic="view", kind="slack", channel="#views", secret_name="sl"),
        dict(topic="click", kind="telegram", channel="@clicks", secret_name=""),
        dict(topic="error", kind="telegram", channel="", secret_name="tg"),
        dict(topic="purchase", kind="slack", channel="#sales", secret_name="sl"),
    ]
    return small_table(spark, rows, "topic string, kind string, channel string, secret_name string")


def _outbox(spark, sf_dir):
    return outbox.notification_outbox(
        derived.ztf_alerts(spark, sf_dir),
        topic_config(spark),
        "ztf",
        ["telegram", "slack"],
        NAMING,
        extra=["candid"],
    )


def notification_outbox(spark, sf_dir):
    return _outbox(spark, sf_dir).select(
        "candid", "topic", "kind", "channel", "route_status", "text", F.size("lightcurve").alias("n_points")
    )


def outbox_throttle(spark, sf_dir):
    timed = outbox.throttle(_outbox(spark, sf_dir).drop("lightcurve", "cutout"), ["topic", "candid"], _received())
    return timed.select(
        "candid", "kind", "channel", F.date_format("not_before", "yyyy-MM-dd HH:mm:ss").alias("not_before")
    )


def live_throttle(spark, sf_dir):
    """The outbox of a live query over several batches: every message of a channel has
    a slot of its own, a gap after the one before, across batches."""
    alerts, path = derived.ztf_alerts(spark, sf_dir).select("topic", "objectId", "candid", "candidate", "prv_candidates"), scratch_path(spark, "log")
    schema, partition = struct_type_to_avro(alerts.drop("topic").schema), F.col("objectId").cast("bigint") % derived.PARTITIONS
    to_topic_log(alerts, schema, F.col("topic"), partition, F.lit("4.0"), ["candid"], timeconv.jd_to_timestamp("candidate.jd"), path)
    job = LiveJob(
        topics=list(EVENT_TYPES), checkpoint=scratch_path(spark, "live-checkpoint"), target=avro_to_struct_type(schema), registry={"4.0": json.dumps(schema)},
        log_path=path, per_trigger=1 + _half(spark, sf_dir) // 2, outbox=scratch_path(spark, "outbox"), topic_config=topic_config(spark), kinds=["telegram", "slack"],
    )
    start_live(spark, job, available_now=True).awaitTermination()
    sent = spark.read.parquet(job.outbox).filter("not_before is not null")
    before = F.lag("not_before").over(W.partitionBy("kind", "channel").orderBy("not_before"))
    spacing = F.when(F.col("kind") == "telegram", 10).otherwise(2)
    gap = (F.unix_micros("not_before") - F.unix_micros(before)) / 1000000
    return sent.select("kind", "channel", "batch", "not_before", (gap >= spacing).alias("spaced")).groupBy("kind", "channel").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("not_before").alias("n_slots"),
        F.bool_and("spaced").alias("spaced"), (F.count_distinct("batch") > 2).alias("several_batches"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        detections_per_object, alert_summary_ztf, alert_summary_lsst, alert_key, display_rows, missing_ids, poll_rows, topic_catalogue,
        date_partitions, date_partitions_nested, partition_fallback, jd_to_mjd, tai_to_utc,
        relative_days_last, relative_days_first, extract_field, lightcurve_long, lightcurve_lsst,
        bands_present, quality_tags, flux_to_mag, object_history, indexed_history,
        legal_topic_name, legal_topic_text, markdown_escape, tag_topic_name,
        topic_log, offset_lag, offset_totals, nonempty_partitions, last_offsets, partition_counts,
        partition_sizes, backlog_report, one_message, start_offsets, partial_start_offsets,
        avro_roundtrip, avro_files_roundtrip, avro_files_union, avro_codecs, gzip_files, first_records, many_versions, encode_missing_fields, wider_schema, poison_keys, multi_schema_union, dead_letters, schema_table,
        drain_archive, drain_resume, drain_avro, bounded_limit, bounded_resume, backlog_after_drain, backlog_from_progress, transfer_progress, backlog_after_live, limited_generation, restart_latest, idle_poll, live_stream,
        archive_overwrite, archive_merge, archive_evolved_schema, archive_ignore, settled_store, latest_per_object,
        cleaned_images, cutout_stats, cutouts_long, object_cutout, plain_fits, notification_outbox, outbox_throttle, live_throttle,
    )
}
