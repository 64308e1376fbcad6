"""One display row, id and key per alert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytide.functions.timeconv import iso_millis, jd_to_timestamp, mjd_tai_to_timestamp, received_at
from skytide.naming import DEFAULT_NAMING, Naming, layout

# Labels of the two LSST identifiers, spelled as displayed.
LSST_OBJECT_LABEL = "diaObjectId"
LSST_MOVING_LABEL = "SSO desgination"


def lsst_id(df: DataFrame) -> tuple[Column, Column]:
    """Id and id label: the static object's if there is one, else the moving object's."""
    static = F.col("diaObject").isNotNull()
    value = F.when(static, F.col("diaObject.diaObjectId").cast("string")).otherwise(
        F.col("mpc_orbits.designation").cast("string")
    )
    return value, F.when(static, LSST_OBJECT_LABEL).otherwise(LSST_MOVING_LABEL)


def alert_summary(df: DataFrame, survey: str, received: Column | None = None) -> DataFrame:
    """The display table: when emitted and received, topic, id and, for ZTF,
    cross-match class and magnitude."""
    layout(survey)
    received = received_at() if received is None else received
    received = F.date_format(received, "yyyy-MM-dd HH:mm:ss").alias("received")
    if survey == "ztf":
        return df.select(
            iso_millis(jd_to_timestamp("candidate.jd")).alias("emitted"),
            received,
            "topic",
            "objectId",
            "cdsxmatch",
            F.col("candidate.magpsf").alias("magpsf"),
        )
    value, label = lsst_id(df)
    return df.select(
        iso_millis(mjd_tai_to_timestamp("diaSource.midpointMjdTai")).alias("emitted"),
        received,
        "topic",
        value.alias("id_value"),
        label.alias("id_name"),
    )


def poll_rows(df: DataFrame, received: Column | None = None) -> DataFrame:
    """Minimal row per polled alert: time of receipt, topic, id and scores."""
    received = received_at() if received is None else received
    scores = [c for c in ("roid", "rfscore", "snn_snia_vs_nonia") if c in df.columns]
    return df.select(received.alias("timestamp"), "topic", "objectId", *scores)


def is_multi_messenger(topic: Column | str = "topic", naming: Naming = DEFAULT_NAMING) -> Column:
    t = F.col(topic) if isinstance(topic, str) else topic
    return F.coalesce(t.isin(*naming.mma_topics), F.lit(False))


def alert_key(df: DataFrame, survey: str, naming: Naming = DEFAULT_NAMING) -> Column:
    """Text key of an alert, ``id1`` or ``id1_id2``.

    Multi-messenger topics use the trigger; for the rest the survey decides. An
    alert that lacks an id is known by its place in the log, where the frame has
    it, so that two of them never share a key; without a place its key is null.
    """

    def joined(names):
        parts = [F.col(c).cast("string") for c in names]
        return F.concat(parts[0], *[p for c in parts[1:] for p in (F.lit("_"), c)])

    key = joined(layout(survey).key)
    if "triggerId" in df.columns and "topic" in df.columns:
        key = F.when(is_multi_messenger("topic", naming), joined(["objectId", "triggerId"])).otherwise(key)
    if not {"topic", "partition", "offset"} <= set(df.columns):
        return key
    return F.coalesce(key, F.concat_ws(":", F.lit("offset"), "topic", "partition", "offset"))


def display_lines(summary: DataFrame) -> DataFrame:
    """One text line per alert of a display table; a missing value shows as ``-``."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in summary.columns]
    return summary.select(F.concat_ws(" | ", *cells).alias("line"))


def print_rows(table: DataFrame) -> None:
    """Print every row, fetched one partition at a time."""
    print(" | ".join(table.columns))
    for row in display_lines(table).toLocalIterator():
        print(row.line)
