"""Which files of an archive hold which object.

The index is a table beside the archive, sorted by object, so that a search reads
few of its row groups and then only files that hold what is sought. Files the index
does not know yet are always read: an old index costs time, not rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytide.session import broadcast_if_small, qualified
from skytide.sources.append_log import AppendLog
from skytide.sources.log_index import list_parquet

MAX_FILES = 10_000
_KNOWN = "file string"


def _objects(path: str, id_column: str) -> str:
    return f"{path.rstrip('/')}-objects/{id_column}"


def _known_log(path: str, id_column: str) -> AppendLog:
    """The files the index covers."""
    return AppendLog(f"{_objects(path, id_column)}-files", _KNOWN, lambda rows: [dict(file=f) for f in sorted({r["file"] for r in rows})])


def _covered(spark: SparkSession, path: str, id_column: str) -> set[str]:
    return {r.file for r in _known_log(path, id_column).read(spark).collect()}


def index_objects(spark: SparkSession, path: str, id_column: str) -> int:
    """Add the files the index does not cover; returns how many there were. Of them a job
    reads the id column alone."""
    path = qualified(spark, path).rstrip("/")
    new = sorted(set(list_parquet(path)) - _covered(spark, path, id_column))
    if not new:
        return 0
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in new])
    # As in the file's own name: a URI decoded once.
    uri = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    file = F.substring_index(uri, "/" + path.split("/")[-1] + "/", -1)
    held = rows.select(F.col(id_column).alias("object"), file.alias("file")).distinct()
    held.repartitionByRange("object", "file").sortWithinPartitions("object", "file").write.mode("append").parquet(_objects(path, id_column))
    _known_log(path, id_column).append([dict(file=f) for f in new])  # last: a write that died is done again
    return len(new)


def files_of(spark: SparkSession, path: str, id_column: str, objects: list | DataFrame, max_files: int = MAX_FILES) -> list[str] | None:
    """Files that may hold some of the objects; None if there is no index, or if they
    are more than ``max_files`` (then a scan of the archive does as well)."""
    path = qualified(spark, path).rstrip("/")
    known = _covered(spark, path, id_column)
    if not known:
        return None
    index = spark.read.parquet(_objects(path, id_column))
    if isinstance(objects, DataFrame):
        ids = objects.select(F.col(id_column).alias("object")).distinct()
        found = index.join(broadcast_if_small(ids), "object", "left_semi")
    else:
        found = index.filter(F.col("object").isin(*objects))
    hits = found.select("file").distinct().limit(max_files + 1).collect()
    if len(hits) > max_files:
        return None
    listed = set(list_parquet(path))
    return [f"{path}/{f}" for f in sorted((listed & {r.file for r in hits}) | (listed - known))]


def read_objects(spark: SparkSession, path: str, id_column: str, objects: list | DataFrame, max_files: int = MAX_FILES) -> DataFrame:
    """The archive as far as it can hold some of the objects; rows of others in the same files too."""
    files = files_of(spark, path, id_column, objects, max_files)
    if files is None:
        return spark.read.parquet(path)
    if not files:
        return spark.read.parquet(path).filter(F.lit(False))
    return spark.read.option("basePath", qualified(spark, path)).schema(spark.read.parquet(path).schema).parquet(*files)
