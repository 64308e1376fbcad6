"""A keyed archive in which replacing an alert writes no more than the alert.

Each write is a commit: a folder of new rows, and positions (file and row number) of
the older rows they replace. A commit counts once its marker file is there, which is
written last. Readers leave replaced rows out by an anti join on their positions, so
files are never rewritten until compaction, which takes the commits of which much
has been replaced, or that are small, together into one.

One writer at a time; readers need no lock.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytide.operators.archive import STORE_MODES, append_parquet, latest_per_key
from skytide.session import broadcast_if_small, open_filesystem, qualified, stage, staging_scope
from skytide.sources.log_index import list_parquet

COMMIT = "commit"
_FILE, _ROW = "_file", "_row"


@dataclass(frozen=True)
class Commit:
    name: str
    rows: int
    deleted: int
    replaces: list[str] = field(default_factory=list)


def _marks(path: str) -> str:
    return f"{path.rstrip('/')}-commits"


def _deletions(path: str) -> str:
    return f"{path.rstrip('/')}-deleted"


def commits(path: str) -> list[Commit]:
    """Commits that count, oldest first."""
    filesystem, inner = open_filesystem(_marks(path))
    found = filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    known = []
    for info in sorted((i for i in found if i.base_name.endswith(".json") and i.base_name[0] != "_"), key=lambda i: i.base_name):
        with filesystem.open_input_stream(info.path) as stream:
            known.append(Commit(**json.loads(stream.read())))
    gone = {name for c in known for name in c.replaces}
    return [c for c in known if c.name not in gone]


def _commit(path: str, done: Commit) -> None:
    filesystem, inner = open_filesystem(_marks(path))
    filesystem.create_dir(inner, recursive=True)
    with filesystem.open_output_stream(f"{inner}/_{done.name}") as out:
        out.write(json.dumps(done.__dict__).encode())
    filesystem.move(f"{inner}/_{done.name}", f"{inner}/{done.name}.json")


def _placed(spark: SparkSession, path: str, live: list[Commit]) -> DataFrame | None:
    """All rows of the commits, replaced ones too, with their file and row number."""
    folders = [f"{path.rstrip('/')}/{COMMIT}={c.name}" for c in live if c.rows]
    if not folders:
        return None
    rows = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*folders)
    file = F.substring_index(F.col("_metadata.file_path"), f"/{COMMIT}=", -1)
    return rows.withColumns({_FILE: file, _ROW: F.col("_metadata.row_index")})


def _current(spark: SparkSession, path: str, live: list[Commit]) -> DataFrame | None:
    rows = _placed(spark, path, live)
    folders = [f"{_deletions(path)}/{COMMIT}={c.name}" for c in live if c.deleted]
    if rows is None or not folders:
        return rows
    deleted = spark.read.parquet(*folders).select(_FILE, _ROW)
    return rows.join(broadcast_if_small(deleted), [_FILE, _ROW], "left_anti")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The archive, one row per key. Filters and columns reach the scan of its files."""
    path = qualified(spark, path)
    rows = _current(spark, path, commits(path))
    if rows is None:
        raise IOError(f"nothing is stored in {path}")
    return rows.drop(_FILE, _ROW, COMMIT)


def _same(left: DataFrame, right: DataFrame, key: list[str]):
    same = F.lit(True)
    for c in key:
        same = same & left[c].eqNullSafe(right[c])
    return same


def merge_alerts(
    df: DataFrame, path: str, key: list[str], mode: str = "error", partitions: list[str] | None = None, order: list[str] | None = None
) -> Commit | None:
    """Store alerts so that each key is held once, and return the commit (None for no row).

    The modes are those of ``archive_alerts``; null key parts are equal. Whatever the
    mode and the layout, what is written are the rows that are new and one position
    for each row replaced. Of the archive only key columns are read. A key may move
    to another partition.
    """
    if mode not in STORE_MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(STORE_MODES)}")
    spark = df.sparkSession
    path = qualified(spark, path)
    name = f"{time.time_ns()}-{uuid.uuid4().hex}"
    with staging_scope():
        if mode == "error":
            fresh = stage(df, "fresh-alerts")
            _refuse(fresh.groupBy(*key).count().filter(F.col("count") > 1), key, path)
        else:
            fresh = stage(latest_per_key(df, key, order or key), "fresh-alerts")
        live, deleted = commits(path), 0
        stored = _current(spark, path, live)
        if stored is not None:
            keys = broadcast_if_small(fresh.select(*key))
            places = stored.select(*key, _FILE, _ROW)
            held = stage(places.join(keys, _same(places, keys, key), "left_semi"), "held-alerts")
            if mode == "error":
                _refuse(held, key, path)
            elif mode == "ignore":
                known = held.select(*key)
                fresh = fresh.join(known, _same(fresh, known, key), "left_anti")
            else:
                deleted = held.count()
                if deleted:
                    held.select(_FILE, _ROW).write.parquet(f"{_deletions(path)}/{COMMIT}={name}")
        append_parquet(fresh, f"{path.rstrip('/')}/{COMMIT}={name}", partitions or [])
        done = Commit(name, _count(spark, path, name), deleted)
        if not done.rows:
            return None
        _commit(path, done)
        return done


def _refuse(keys: DataFrame, key: list[str], path: str) -> None:
    first = keys.select(*key).limit(1).collect()
    if first:
        raise IOError(f"alert {'_'.join(str(v) for v in first[0])} already exists in {path}")


def _count(spark: SparkSession, path: str, name: str) -> int:
    """Rows of a commit's folder, from the files' footers; it may have none."""
    folder = f"{path.rstrip('/')}/{COMMIT}={name}"
    return spark.read.parquet(folder).count() if list_parquet(folder) else 0


def compact_merged(
    spark: SparkSession, path: str, partitions: list[str] | None = None, replaced: float = 0.3, small_rows: int = 100_000
) -> Commit | None:
    """Rewrite as one commit those of which a share of at least ``replaced`` has been
    replaced, or that hold fewer than ``small_rows``; None if that is not two of them
    and none has replaced rows."""
    path = qualified(spark, path)
    live = commits(path)
    folders = [f"{_deletions(path)}/{COMMIT}={c.name}" for c in live if c.deleted]
    gone: dict[str, int] = {}
    if folders:
        owner = F.substring_index(_FILE, "/", 1).alias("owner")
        gone = {r.owner: r["count"] for r in spark.read.parquet(*folders).groupBy(owner).count().collect()}
    chosen = [c for c in live if c.rows < small_rows or gone.get(c.name, 0) >= replaced * c.rows]
    if not chosen or (len(chosen) == 1 and not gone.get(chosen[0].name)):
        return None
    # Positions a chosen commit brought about rows of others must stay.
    names = {c.name for c in chosen}
    kept = _current(spark, path, live).filter(F.col(COMMIT).cast("string").isin(*names)).drop(_FILE, _ROW, COMMIT)
    name = f"{time.time_ns()}-{uuid.uuid4().hex}"
    append_parquet(kept, f"{path.rstrip('/')}/{COMMIT}={name}", partitions or [])
    deleted = 0
    mine = [f"{_deletions(path)}/{COMMIT}={c.name}" for c in chosen if c.deleted]
    if mine:
        others = spark.read.parquet(*mine).select(_FILE, _ROW).filter(~F.substring_index(_FILE, "/", 1).isin(*names))
        others.write.parquet(f"{_deletions(path)}/{COMMIT}={name}")
        deleted = spark.read.parquet(f"{_deletions(path)}/{COMMIT}={name}").count()
    done = Commit(name, _count(spark, path, name), deleted, sorted(names))
    _commit(path, done)
    return done


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the folders of commits that a compaction has replaced. Readers that began
    before it may still want them: call this once those are over."""
    path = qualified(spark, path)
    filesystem, inner = open_filesystem(path)
    live = {c.name for c in commits(path)}
    marks = filesystem.get_file_info(pafs.FileSelector(open_filesystem(_marks(path))[1], allow_not_found=True))
    known = {i.base_name.removesuffix(".json") for i in marks if i.base_name.endswith(".json")}
    dropped = 0
    for root in (inner, open_filesystem(_deletions(path))[1]):
        for info in filesystem.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            name = info.base_name.removeprefix(f"{COMMIT}=")
            if not info.is_file and name in known - live:
                filesystem.delete_dir(info.path)
                dropped += 1
    return dropped
