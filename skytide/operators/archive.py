"""Archiving alerts: partition columns, Parquet appends, keyed stores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skytide.functions.timeconv import date_parts
from skytide.naming import DEFAULT_NAMING, Naming, layout
from skytide.operators.settled import BATCH, compact_store, store_parts
from skytide.session import broadcast_if_small, read_table_if_exists, stage, staging_scope

DATE_COLUMNS = ["year", "month", "day"]
FORMATS = ("parquet", "avro")
STORE_MODES = ("error", "overwrite", "ignore")
_MAX_FOLDER_FILTER = 1000


def strategies(naming: Naming = DEFAULT_NAMING) -> tuple[str, ...]:
    return ("time", naming.class_column, "tnsclass", "classId")


def check_archive_arguments(by: str | None, survey: str, out_format: str, naming: Naming = DEFAULT_NAMING) -> None:
    layout(survey)
    if by is not None and by not in strategies(naming):
        raise ValueError(f"unknown partitioning {by!r}, expected one of {', '.join(strategies(naming))}")
    if survey == "lsst" and by not in (None, "time"):
        raise ValueError(f"partitioning by {by!r} is not available for lsst")
    if out_format not in FORMATS:
        raise ValueError(f"unknown output format {out_format!r}, expected one of {', '.join(FORMATS)}")


def with_partitions(
    df: DataFrame, by: str | None, survey: str, naming: Naming = DEFAULT_NAMING
) -> tuple[DataFrame, list[str]]:
    """Add the partition columns of a strategy and name them; no name, no partitioning.

    ``time`` takes the top-level time column, else the one inside the survey's
    measurement struct. The class column, when absent, falls back to a
    top-level time column only. Columns are decided from the schema, values
    stay column expressions.
    """
    shape = layout(survey)

    def dated(path: str) -> tuple[DataFrame, list[str]]:
        kept = [c for c in df.columns if c not in DATE_COLUMNS] if "year" in df.columns else df.columns
        parts = date_parts(path, shape.time_format)
        return df.select(*kept, *[parts[c].alias(c) for c in DATE_COLUMNS]), DATE_COLUMNS

    if by == "time":
        if shape.time in df.columns:
            return dated(shape.time)
        if shape.current in df.columns:
            return dated(f"{shape.current}.{shape.time}")
        return df, []
    if by == naming.class_column:
        if by in df.columns:
            return df, [by]
        return dated(shape.time) if shape.time in df.columns else (df, [])
    if by in ("tnsclass", "classId"):
        if by not in df.columns:
            raise ValueError(f"cannot partition by {by!r}: no such column")
        return df, [by]
    return df, []


def append_parquet(df: DataFrame, path: str, partitions: list[str], gather: bool = False, lookup: list[str] | None = None) -> None:
    """Append to a hive-partitioned dataset; file names are unique per write.

    ``lookup`` names columns that rows will be sought by, an object's id in an
    archive laid out by day: files are sorted by them and carry a bloom filter,
    so that a search skips the row groups and files that cannot hold a value.

    Every task writes one file per partition value it holds. ``gather`` first
    brings equal values together with a rebalance, which splits a value that is
    too large for one task instead of overloading it.
    """
    if gather and partitions:
        df = df.hint("rebalance", *partitions)
    options = {}
    if lookup:
        df = df.sortWithinPartitions(*partitions, *lookup)
        options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in lookup}
    df.write.options(**options).mode("append").partitionBy(*partitions).parquet(path)


def latest_per_key(df: DataFrame, key: list[str], order: list[str], first: bool = False) -> DataFrame:
    """Keep the last (or first) row of each key.

    Spark turns the rank filter into a limit inside each map task first, so a
    key with very many copies is cut down before the shuffle.
    """
    best = W.partitionBy(*key).orderBy(*[F.col(c) if first else F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") == 1).drop("_rank")


def _clash(keys: DataFrame, key: list[str], path: str) -> None:
    first = keys.select(*key).limit(1).collect()
    if first:
        raise IOError(f"alert {'_'.join(str(v) for v in first[0])} already exists in {path}")


def _in_partitions_of(stored: DataFrame, rows: DataFrame, partitions: list[str]) -> DataFrame:
    """Stored rows of the partitions that ``rows`` fall into.

    A moderate number of partition values becomes a filter on folders, so all
    others are never opened; more of them become a join.
    """
    values = rows.select(*[F.col(c).cast("string") for c in partitions]).distinct()
    touched = values.limit(_MAX_FOLDER_FILTER + 1).collect()
    if len(touched) <= _MAX_FOLDER_FILTER:
        keep = F.lit(False)
        for row in touched:
            here = F.lit(True)
            for c in partitions:
                here = here & F.col(c).cast("string").eqNullSafe(F.lit(row[c]))
            keep = keep | here
        return stored.filter(keep)
    match = F.lit(True)
    for c in partitions:
        match = match & F.col(f"s.{c}").cast("string").eqNullSafe(F.col(f"t.{c}"))
    return stored.alias("s").join(broadcast_if_small(values).alias("t"), match, "left_semi")


def archive_alerts(
    df: DataFrame,
    path: str,
    key: list[str],
    mode: str = "error",
    partitions: list[str] | None = None,
    order: list[str] | None = None,
    trust_partitions: bool = False,
) -> None:
    """Store alerts so that each key is held once.

    ``error`` refuses a key that is already stored, ``ignore`` keeps the stored
    row, ``overwrite`` replaces it. Several rows of one key in the input: the
    last by ``order`` counts, except that ``error`` refuses them. A partition
    value must follow from the key; this is checked against all stored keys
    unless ``trust_partitions`` says it holds, in which case only partitions the
    input falls into are looked at. An overwrite rewrites those partitions from
    a staged copy, so nothing is read and replaced in one plan.

    Columns only the stored rows have, or only the new ones, are kept, null for
    the others; null key parts are equal. The stored side is read for its key
    columns only and is the streamed side of every join: up to the row count of
    ``broadcast_if_small`` the input is broadcast and the archive not shuffled.
    """
    if mode not in STORE_MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(STORE_MODES)}")
    with staging_scope():
        _archive(df, path, key, mode, partitions or [], order or key, trust_partitions)


def _stored(spark, path: str):
    """The archive with the columns of all its files."""
    return read_table_if_exists(spark, path, merge_schema=True)


def _same_key(left: DataFrame, right: DataFrame, key: list[str]):
    """Keys are equal, null parts included."""
    same = F.lit(True)
    for c in key:
        same = same & left[c].eqNullSafe(right[c])
    return same


def _archive(df, path, key, mode, partitions, order, trust_partitions) -> None:
    spark = df.sparkSession
    stored = _stored(spark, path)
    if mode == "error":
        fresh = stage(df, "fresh-alerts")
        _clash(fresh.groupBy(*key).count().filter(F.col("count") > 1), key, path)
    else:
        fresh = latest_per_key(df, key, order)
        if stored is not None:
            fresh = stage(fresh, "fresh-alerts")
    if stored is None:
        append_parquet(fresh, path, partitions)
        return
    fresh_keys = broadcast_if_small(fresh.select(*key, *partitions))
    near = _in_partitions_of(stored, fresh, partitions) if trust_partitions and partitions else stored
    if mode != "overwrite":
        keys = near.select(*key)
        held = keys.join(fresh_keys, _same_key(keys, fresh_keys, key), "left_semi")
        if mode == "error":
            _clash(held, key, path)
            append_parquet(fresh, path, partitions)
        else:
            held = held.distinct()
            append_parquet(fresh.join(held, _same_key(fresh, held, key), "left_anti").select(*df.columns), path, partitions)
        return
    if partitions and not trust_partitions:
        differs = F.lit(False)
        for c in partitions:
            differs = differs | ~F.col(f"o.{c}").cast("string").eqNullSafe(F.col(f"n.{c}").cast("string"))
        same = F.lit(True)
        for c in key:
            same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
        moved = stored.select(*key, *partitions).alias("o").join(fresh_keys.alias("n"), same).filter(differs)
        if not moved.isEmpty():
            raise ValueError("a stored alert would move to another partition: partition values must follow from the key")
        near = _in_partitions_of(stored, fresh, partitions)
    kept = near.join(fresh_keys, _same_key(near, fresh_keys, key), "left_anti")
    # Partition values come back as text. All other columns of either side stay,
    # in the wider of two types.
    kept = kept.withColumns({c: F.col(c).cast(fresh.schema[c].dataType) for c in partitions})
    merged = stage(fresh.unionByName(kept, allowMissingColumns=True), "merged-alerts")
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


# -- append-only store ----------------------------------------------------------

def store_batch(
    df: DataFrame, path: str, batch_id: int, key: list[str], mode: str = "overwrite", partitions: list[str] | None = None
) -> None:
    """Add one micro-batch of a stream to a keyed store.

    Each batch has a folder of its own, so repeating a batch replaces it and no
    stored row is ever rewritten; which version of a key counts is settled by
    ``read_store``. Only ``error`` looks at earlier batches.
    """
    if mode not in STORE_MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(STORE_MODES)}")
    if mode == "error":
        _clash(df.groupBy(*key).count().filter(F.col("count") > 1), key, path)
        for stored in store_parts(df.sparkSession, path):
            if stored is not None:
                earlier = stored.filter(F.col(BATCH).cast("bigint") != batch_id).select(*key)
                _clash(earlier.join(broadcast_if_small(df.select(*key)), key, "left_semi"), key, path)
    df.write.mode("overwrite").partitionBy(*(partitions or [])).parquet(f"{path}/{BATCH}={batch_id}")


def read_store(spark: SparkSession, path: str, key: list[str], order: list[str], mode: str = "overwrite") -> DataFrame:
    """The store as one row per key: the last version stored, or the first one
    for a store kept in ``ignore`` mode. Settled partitions are read as they are."""
    closed, open_rows = store_parts(spark, path)
    if closed is None and open_rows is None:
        raise IOError(f"nothing is stored in {path}")
    if open_rows is None:
        return closed
    latest = latest_per_key(open_rows, key, [BATCH, *order], first=mode == "ignore")
    return latest if closed is None else closed.unionByName(latest, allowMissingColumns=True)


def settle_store(
    spark: SparkSession, path: str, key: list[str], order: list[str], closed: Callable[[dict], bool],
    mode: str = "overwrite", upto: int | None = None,
) -> list[str]:
    """Rewrite closed partitions of a store to one row per key (see ``compact_store``)."""
    return compact_store(spark, path, key, closed, lambda rows: latest_per_key(rows, key, [BATCH, *order], first=mode == "ignore"), upto)


def days_before(day: str) -> Callable[[dict], bool]:
    """Accepts the day partitions before ``day`` (YYYY-MM-DD); rows without a day stay open."""
    limit = tuple(day.split("-"))
    return lambda values: None not in (at := tuple(values.get(c) for c in DATE_COLUMNS)) and at < limit
