"""Compaction of a keyed store that only ever appends.

A stream's store holds every version of a key, in a folder per batch. Compaction
rewrites closed partitions, days that are over as a rule, to the one version that
counts, in a folder of its own beside the store. A manifest, a small file replaced as
a whole, says which partition is settled where and up to which batch. Readers take
settled partitions as they are and settle versions only of the rest; a late row
reopens its partition until the next compaction.

The partition of a row must follow from its key, as in a batch archive.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytide.session import open_filesystem, qualified, read_table_if_exists
from skytide.sources.log_index import list_parquet

BATCH = "batch"
_NULL = "__HIVE_DEFAULT_PARTITION__"

# partition folder, such as "year=2024/month=01/day=02", to generation and last batch
Manifest = dict[str, tuple[str, int]]


def settled_path(path: str) -> str:
    return f"{path.rstrip('/')}-settled"


def _manifests(path: str) -> list[str]:
    filesystem, inner = open_filesystem(settled_path(path))
    found = filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    return sorted(i.path for i in found if i.is_file and i.base_name.startswith("manifest-"))


def _load(path: str, name: str) -> Manifest:
    filesystem, _ = open_filesystem(settled_path(path))
    with filesystem.open_input_stream(name) as stream:
        return {part: (generation, upto) for part, (generation, upto) in json.loads(stream.read()).items()}


def read_manifest(path: str) -> Manifest:
    names = _manifests(path)
    return _load(path, names[-1]) if names else {}


def _write_manifest(path: str, manifest: Manifest) -> None:
    filesystem, inner = open_filesystem(settled_path(path))
    name = f"manifest-{time.time_ns()}-{uuid.uuid4().hex}.json"
    with filesystem.open_output_stream(f"{inner}/_{name}") as out:
        out.write(json.dumps(manifest).encode())
    filesystem.move(f"{inner}/_{name}", f"{inner}/{name}")


def batch_folders(path: str) -> list[tuple[int, str]]:
    """Batch number and partition folder of everything the store has appended."""
    folders = {file.rpartition("/")[0] for file in list_parquet(path)}
    split = [f.partition("/") for f in folders if f.startswith(f"{BATCH}=")]
    return sorted((int(head.removeprefix(f"{BATCH}=")), part) for head, _, part in split)


def _values(part: str) -> dict[str, str | None]:
    pairs = [p.partition("=") for p in part.split("/") if p]
    return {name: None if value == _NULL else unquote(value) for name, _, value in pairs}


def _appended(spark: SparkSession, path: str, folders: list[tuple[int, str]]) -> DataFrame:
    files = [f"{path.rstrip('/')}/{BATCH}={n}/{part}".rstrip("/") for n, part in folders]
    rows = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*files)
    return rows.withColumn(BATCH, F.col(BATCH).cast("bigint"))


def _settled(spark: SparkSession, path: str, manifest: Manifest, parts: list[str]) -> DataFrame:
    root = settled_path(path)
    files = [f"{root}/generation={manifest[p][0]}/{p}".rstrip("/") for p in parts]
    return spark.read.option("mergeSchema", True).option("basePath", root).parquet(*files).drop("generation")


def store_parts(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows that are settled, and rows whose versions are still to be settled."""
    path = qualified(spark, path)
    manifest = read_manifest(path)
    if not manifest:
        rows = read_table_if_exists(spark, path, merge_schema=True)
        return None, None if rows is None else rows.withColumn(BATCH, F.col(BATCH).cast("bigint"))
    later = [(n, part) for n, part in batch_folders(path) if part not in manifest or n > manifest[part][1]]
    reopened = sorted({part for _, part in later} & set(manifest))
    closed = sorted(set(manifest) - set(reopened))
    open_rows = _appended(spark, path, later) if later else None
    if reopened:
        open_rows = _settled(spark, path, manifest, reopened).unionByName(open_rows, allowMissingColumns=True)
    return (_settled(spark, path, manifest, closed) if closed else None), open_rows


def compact_store(
    spark: SparkSession,
    path: str,
    key: list[str],
    closed: Callable[[dict[str, str | None]], bool],
    settle: Callable[[DataFrame], DataFrame],
    upto: int | None = None,
) -> list[str]:
    """Settle the partitions that ``closed`` (given their values) accepts, and return the
    folders written. ``settle`` reduces rows to those that count.

    Batches after ``upto`` are left for later; by default that is the newest one,
    which a restarted stream may write again. Only partitions with new batches are
    rewritten; a partition is one task's work only if it is that small.
    """
    path = qualified(spark, path)
    manifest, folders = read_manifest(path), batch_folders(path)
    if upto is None:
        upto = max((n for n, _ in folders), default=0) - 1
    new = [(n, part) for n, part in folders if n <= upto and closed(_values(part)) and n > manifest.get(part, ("", -1))[1]]
    parts = sorted({part for _, part in new})
    if not parts:
        return []
    rows = _appended(spark, path, new)
    known = [p for p in parts if p in manifest]
    if known:
        rows = _settled(spark, path, manifest, known).unionByName(rows, allowMissingColumns=True)
    names = list(_values(parts[0]))
    if names:
        place = F.struct(*[F.col(c).cast("string") for c in names])
        moved = rows.groupBy(*key).agg(F.count_distinct(place).alias("places")).filter(F.col("places") > 1)
        if not moved.isEmpty():
            raise ValueError("a stored alert lies in two partitions: partition values must follow from the key")
    generation = f"{time.time_ns()}-{uuid.uuid4().hex}"
    settle(rows).write.partitionBy(*names).parquet(f"{settled_path(path)}/generation={generation}")
    _write_manifest(path, {**manifest, **{p: (generation, upto) for p in parts}})
    return parts


def drop_settled(spark: SparkSession, path: str) -> int:
    """Delete what the manifest before the newest has made useless, so that readers of
    that one are not disturbed: batch folders it covers, and generations neither names."""
    path = qualified(spark, path)
    names = _manifests(path)
    if len(names) < 2:
        return 0
    before, now = _load(path, names[-2]), _load(path, names[-1])
    filesystem, inner = open_filesystem(path)
    useless = [f"{inner}/{BATCH}={n}/{part}".rstrip("/") for n, part in batch_folders(path) if part in before and n <= before[part][1]]
    named = {(generation, part) for m in (before, now) for part, (generation, _) in m.items()}
    root = open_filesystem(settled_path(path))[1]
    kept = {f"generation={generation}/{part}".rstrip("/") for generation, part in named}
    useless += [f"{root}/{folder}" for folder in {f.rpartition("/")[0] for f in list_parquet(settled_path(path))} - kept]
    for folder in useless:
        filesystem.delete_dir(folder)
    for name in names[:-2]:
        filesystem.delete_file(name)
    return len(useless)
