"""Notification outbox: which alert goes to which channel, saying what, when."""

from __future__ import annotations

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytide.functions.text import notification_text
from skytide.naming import DEFAULT_NAMING, Naming, layout
from skytide.operators.lightcurve import extract_field
from skytide.operators.numbering import number_in_blocks, number_rows
from skytide.session import broadcast_if_small, open_filesystem, qualified

# Seconds between two messages to one channel.
SPACING_SECONDS = {"telegram": 10, "slack": 2}

ROUTED, NO_ENTRY, NO_SECRET, NO_CHANNEL = "routed", "no entry for topic", "no secret", "no channel"


def route(alerts: DataFrame, topic_config: DataFrame, kinds: list[str]) -> DataFrame:
    """One row per alert and enabled channel kind, with ``channel``,
    ``secret_name`` and ``route_status``.

    The configuration (topic, kind, channel, secret_name) holds names of
    secrets only. An alert without a usable entry is kept and marked.
    """
    config = broadcast_if_small(topic_config.select("topic", "kind", "channel", "secret_name", F.lit(True).alias("_known")))
    wanted = alerts.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds])))
    joined = wanted.join(config, ["topic", "kind"], "left")
    blank_secret = F.coalesce(F.trim("secret_name"), F.lit("")) == ""
    blank_channel = F.coalesce(F.trim("channel"), F.lit("")) == ""
    status = (
        F.when(F.col("_known").isNull(), NO_ENTRY)
        .when(blank_secret, NO_SECRET)
        .when(blank_channel, NO_CHANNEL)
        .otherwise(ROUTED)
    )
    return joined.withColumn("route_status", status).drop("_known")


def notification_outbox(
    alerts: DataFrame,
    topic_config: DataFrame,
    survey: str,
    kinds: list[str],
    naming: Naming = DEFAULT_NAMING,
    object_id: Column | None = None,
    init_message: str | None = None,
    extra: list[str] | None = None,
) -> DataFrame:
    """Messages to send: channel, text, light curve as aligned arrays, Science
    cutout. Routing problems stay visible in ``route_status``; messages with an
    empty text are left out. Delivery is not part of this library.
    """
    shape = layout(survey)
    if object_id is None:
        object_id = F.col("objectId") if survey == "ztf" else F.col("diaSource.diaObjectId")
    curve = F.arrays_zip(
        *[extract_field(alerts, f, shape.current, shape.history).alias(f) for f in shape.photometry]
    )
    if "cutoutScience" in alerts.columns:
        nested = isinstance(alerts.schema["cutoutScience"].dataType, T.StructType)
        cutout = F.col("cutoutScience.stampData" if nested else "cutoutScience")
    else:
        cutout = F.lit(None).cast("binary")
    carried = [c for c in (extra or []) if c not in ("topic", "kind")]
    base = alerts.select(
        "topic", *carried, object_id.cast("string").alias("object_id"), curve.alias("lightcurve"), cutout.alias("cutout")
    )
    text = notification_text("kind", "object_id", "topic", survey, naming)
    return (
        route(base, topic_config, kinds)
        .select(
            "topic",
            "kind",
            *carried,
            "object_id",
            "channel",
            "secret_name",
            "route_status",
            F.lit(init_message or None).cast("string").alias("init_message"),
            text.alias("text"),
            "lightcurve",
            "cutout",
        )
        .filter(F.trim(F.coalesce("text", F.lit(""))) != "")
    )


def throttle(
    outbox: DataFrame,
    order: list[str],
    start: Column,
    spacing: dict[str, int] | None = None,
    busy_until: DataFrame | None = None,
    by_offset: bool = False,
) -> DataFrame:
    """Add ``not_before``: messages of one channel are spaced out in order.

    A channel starts at ``start``, or one gap after the message it is already
    waiting to send (``busy_until``: kind, channel, last). Places in a queue
    come from ranged numbering, so one channel that takes most messages is
    still spread over many tasks; only the columns that decide the order are numbered,
    which must be unique within a channel, and joined to the messages again. With
    ``by_offset`` the order ends in an offset: places are then counted by blocks of
    offsets, and the messages, with their light curves, are not shuffled.
    """
    seconds = F.lit(0)
    for kind, gap in (spacing or SPACING_SECONDS).items():
        seconds = F.when(F.col("kind") == kind, F.lit(gap)).otherwise(seconds)
    gap_micros = seconds.cast("bigint") * 1000000
    if by_offset:
        placed = number_in_blocks(outbox, ["kind", "channel"], order, "queue_position", "outbox")
    else:
        key = ["kind", "channel", *[c for c in order if c not in ("kind", "channel")]]
        slim = number_rows(outbox.select(*key), ["kind", "channel"], order, "queue_position", "outbox")
        numbers = broadcast_if_small(slim)
        same = F.lit(True)
        for c in key:
            same = same & outbox[c].eqNullSafe(numbers[c])
        placed = outbox.join(numbers, same).select(*[outbox[c] for c in outbox.columns], "queue_position")
    first = F.unix_micros(start)
    if busy_until is not None:
        waiting = busy_until.select("kind", "channel", F.unix_micros("last").alias("_last"))
        placed = placed.join(broadcast_if_small(waiting), ["kind", "channel"], "left")
        first = F.greatest(first, F.col("_last") + gap_micros)
    due = F.timestamp_micros(first + F.col("queue_position") * gap_micros)
    return placed.withColumn("not_before", F.when(F.col("route_status") == ROUTED, due)).select(
        *outbox.columns, "queue_position", "not_before"
    )


def last_slots(messages: DataFrame) -> DataFrame:
    """Per channel the time of its last message."""
    timed = messages.filter(F.col("not_before").isNotNull())
    return timed.groupBy("kind", "channel").agg(F.max("not_before").alias("last"))


class ChannelState:
    """What a stream knows of its channels: one row each, kept anew by every batch.

    A batch reads what the one before it kept, however many there have been; the
    state before that stays too, so a repeated batch begins where it began.
    """

    _FOLDER = "batch="

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, qualified(spark, path).rstrip("/")

    def _batches(self) -> list[int]:
        filesystem, inner = open_filesystem(self.path)
        found = filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
        return sorted(int(i.base_name.removeprefix(self._FOLDER)) for i in found if i.base_name.startswith(self._FOLDER))

    def before(self, batch_id: int) -> DataFrame | None:
        earlier = [n for n in self._batches() if n < batch_id]
        return self.spark.read.parquet(f"{self.path}/{self._FOLDER}{earlier[-1]}") if earlier else None

    def keep(self, batch_id: int, messages: DataFrame) -> None:
        """The state after a batch's messages; folders older than the one before it go."""
        slots, earlier = last_slots(messages), self.before(batch_id)
        if earlier is not None:
            slots = slots.unionByName(earlier).groupBy("kind", "channel").agg(F.max("last").alias("last"))
        slots.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{self._FOLDER}{batch_id}")
        filesystem, inner = open_filesystem(self.path)
        for old in [n for n in self._batches() if n < batch_id][:-1]:
            filesystem.delete_dir(f"{inner}/{self._FOLDER}{old}")
