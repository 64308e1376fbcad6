"""Contiguous shards of near equal bytes, by global prefix sums.

Rows are sorted by id across the cluster. Each range of that order gives its
total bytes and rows; sums over those few totals place every range, a running
sum within the range places every row, and the order is cut where the bytes
before a row cross multiples of ``total / n_shards``. Only narrow rows are
sorted, the texts are read once; no range depends on a key's frequency, since
equal ids and texts are told apart by their place in the input.

A null or empty text counts one byte and has checksum 0. Null ids sort first.
Repeated rows are rows of their own; their places among each other may differ
between runs, which no column of the result shows. More shards than rows leave
shards empty, no rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skytide.session import broadcast_if_small, stage

N_SHARDS = 16
_RANGE_BITS = 33  # of monotonically_increasing_id: partition above, position below


def shard_by_bytes(
    docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and the columns named in ``carry``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"),
        *[F.col(c).alias(f"_carry_{c}") for c in carry],
    )
    order = ["doc_id", "text_crc32", "size", "_row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = stage(placed.drop("_row"), "sorted").withColumn("_range", F.shiftright("_place", _RANGE_BITS))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    ranges = (
        placed.groupBy("_range")
        .agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
        .select(
            "_range", "_first",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
            F.sum("_bytes").over(W.partitionBy()).alias("_total"),
        )
    )
    running = W.partitionBy("_range").orderBy("_place").rowsBetween(W.unboundedPreceding, W.currentRow)
    start = F.col("_bytes_before") + F.sum("size").over(running) - F.col("size")
    numbered = (
        placed.join(broadcast_if_small(ranges), "_range")
        .withColumn("shard", F.floor(start * n_shards / F.col("_total")).cast("int"))
        .withColumn("_index", F.col("_rows_before") + F.col("_place") - F.col("_first"))
        .select("doc_id", "size", "text_crc32", "shard", "_index", *[f"_carry_{c}" for c in carry])
    )
    numbered = stage(numbered, "numbered")
    firsts = numbered.groupBy("shard").agg(F.min("_index").alias("_shard_first"))
    return numbered.join(broadcast_if_small(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_index") - F.col("_shard_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"_carry_{c}").alias(c) for c in carry],
    )
