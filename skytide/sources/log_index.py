"""Which offsets of which topic partition each file of a topic log holds.

The index is a small table beside the log. It answers where a topic begins and
ends, and which files hold a range of offsets, without reading any message.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytide.session import open_filesystem, qualified, small_table

INDEX_SCHEMA = "file string, topic string, partition int, lo bigint, hi bigint"
_TOPIC_FOLDER = "topic="


@dataclass(frozen=True)
class Held:
    """What one file holds of one topic partition: offsets ``[lo, hi)``."""

    file: str
    topic: str
    partition: int
    lo: int
    hi: int


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}-ranges"


def list_parquet(path: str, topics: set[str] | None = None) -> dict[str, int]:
    """Finished Parquet files under a folder, relative to it, with their sizes; given
    topics, folders of other topics are not listed."""
    filesystem, inner = open_filesystem(path)
    inner = inner.rstrip("/")
    top = filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    found = [i for i in top if i.is_file]
    for folder in (i for i in top if not i.is_file and not i.base_name.startswith(("_", "."))):
        if topics is None or topic_of(f"{folder.base_name}/") in (None, *topics):
            found += filesystem.get_file_info(pafs.FileSelector(folder.path, recursive=True))
    names = {i.path[len(inner) + 1 :]: i.size for i in found if i.is_file and i.path.endswith(".parquet")}
    return {n: s for n, s in names.items() if not any(part.startswith(("_", ".")) for part in n.split("/"))}


def topic_of(file: str) -> str | None:
    """The topic a file's folder names; a log may also keep it as a column."""
    for part in file.split("/")[:-1]:
        if part.startswith(_TOPIC_FOLDER):
            return unquote(part[len(_TOPIC_FOLDER) :])
    return None


def read_index(path: str) -> list[Held]:
    """The stored index, as far as it goes, without files known to be gone."""
    filesystem, inner = open_filesystem(index_path(path))
    held: list[Held] = []
    for name in sorted(list_parquet(index_path(path))):
        rows = pq.read_table(f"{inner.rstrip('/')}/{name}", filesystem=filesystem).to_pylist()
        held.extend(Held(**r) for r in rows)
    gone = {h.file for h in held if h.partition is None}
    return [h for h in held if h.file not in gone]


def ranges_of_file(path: str, file: str) -> list[Held]:
    """The index rows of one file, from its offset and partition columns alone."""
    filesystem, inner = open_filesystem(path)
    topic = topic_of(file)
    columns = ["partition", "offset"] + ["topic"] * (topic is None)
    table = pq.ParquetFile(filesystem.open_input_file(f"{inner.rstrip('/')}/{file}")).read(columns)
    if topic is not None:
        table = table.append_column("topic", pa.array([topic] * len(table), pa.string()))
    grouped = table.group_by(["topic", "partition"]).aggregate([("offset", "min"), ("offset", "max")])
    return [Held(file, r["topic"], r["partition"], r["offset_min"], r["offset_max"] + 1) for r in grouped.to_pylist()]


def index_log(spark: SparkSession, path: str) -> None:
    """Bring the index up to date: a job reads two columns of the files it lacks; files
    that are gone are marked (by a row without partition)."""
    path = qualified(spark, path)
    known, listed = {h.file for h in read_index(path)}, set(list_parquet(path))
    new, gone = sorted(listed - known), sorted(known - listed)
    if gone:
        marks = [dict(file=f, topic=None, partition=None, lo=None, hi=None) for f in gone]
        small_table(spark, marks, INDEX_SCHEMA).coalesce(1).write.mode("append").parquet(index_path(path))
    if not new:
        return
    root = path.rstrip("/")
    in_folders = topic_of(new[0]) is not None
    schema = "partition int, offset bigint" + ("" if in_folders else ", topic string")
    rows = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in new])
    # file_path is a URI: decoded once it is the file's name, in which the folder's topic is escaped again
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    below = F.substring_index(name, "/" + root.strip("/").split("/")[-1] + "/", -1)
    held = rows.groupBy(below.alias("file"), "topic", "partition").agg(F.min("offset").alias("lo"), (F.max("offset") + 1).alias("hi"))
    held = held.select("file", F.col("topic").cast("string").alias("topic"), F.col("partition").cast("int").alias("partition"), "lo", "hi")
    held.coalesce(1).write.mode("append").parquet(index_path(path))


def log_bounds(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """First offset and one past the last offset of every topic partition of a log,
    from the index. The end does not move back when files go."""
    index_log(spark, path)
    if not list_parquet(index_path(qualified(spark, path))):
        return small_table(spark, [], "topic string, partition int, lo bigint, hi bigint")
    index = spark.read.schema(INDEX_SCHEMA).parquet(index_path(path))
    held = index.filter(F.col("partition").isNotNull())
    if topics is not None:
        held = held.filter(F.col("topic").isin(*topics))
    gone = index.filter(F.col("partition").isNull()).select("file", F.lit(True).alias("gone")).distinct()
    here = F.when(F.col("gone").isNull(), F.col("lo"))
    ends = held.join(gone, "file", "left").groupBy("topic", "partition").agg(F.min(here).alias("lo"), F.max("hi").alias("hi"))
    return ends.withColumn("lo", F.coalesce("lo", "hi"))
