"""Dense row numbers inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skytide.session import broadcast_if_small, stage

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below
_BLOCK_BITS = 15  # a bitmap of Spark's holds so many bits' worth of numbers
_BROADCAST_BLOCKS = 10_000


def number_rows(df: DataFrame, group: list[str], order: list[str], name: str, label: str = "numbered") -> DataFrame:
    """Add ``name``: 0, 1, 2, … within each group in the given order.

    A window over the group would send a hot group to one task. Here rows are
    range-partitioned by group and order, so a large group spans many tasks;
    each row's place in its own range is written out once, and the places of
    earlier ranges are added from one small count per (group, range). The
    order columns must be unique within a group.
    """
    placed = (
        df.repartitionByRange(*[F.col(c) for c in group + order])
        .sortWithinPartitions(*group, *order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    staged = stage(placed, label).withColumn("_range", F.shiftright("_place", _POSITION_BITS))
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        staged.groupBy(*group, "_range")
        .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
        .select(*group, "_range", "_base")
    )
    same = F.col("s._range") == F.col("b._range")
    for c in group:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}"))
    return staged.alias("s").join(broadcast_if_small(bases).alias("b"), same).select(
        *[F.col(f"s.{c}") for c in df.columns], (F.col("s._place") + F.col("b._base")).alias(name)
    )


def number_in_blocks(df: DataFrame, group: list[str], order: list[str], name: str, label: str = "blocks") -> DataFrame:
    """Add ``name`` as ``number_rows`` does, but leave the rows of ``df`` where they are.

    For wide rows whose last order column is a whole number from 0 on, mostly
    without gaps, as offsets are; no order column may be null. One small row per
    block of 32,768 numbers says how many rows come before it and, where numbers
    are missing, which are there; beyond 10,000 blocks the rows are shuffled to them.
    """
    *head, last = order
    key = list(dict.fromkeys([*group, *head]))
    number = F.col(last).cast("bigint")
    bit = number.bitwiseAND((1 << _BLOCK_BITS) - 1)
    blocks = (
        df.groupBy(*key, F.shiftright(number, _BLOCK_BITS).alias("_block"))
        .agg(F.min(number).alias("_low"), F.max(number).alias("_high"), F.bitmap_construct_agg(bit).alias("_bits"))
        .withColumn("_n", F.bitmap_count("_bits"))
        .withColumn("_bits", F.when(F.col("_n") <= F.col("_high") - F.col("_low"), F.col("_bits")))
    )
    before = W.partitionBy(*group).orderBy(*[c for c in head if c not in group], "_block").rowsBetween(W.unboundedPreceding, -1)
    staged = stage(blocks.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_high", "_n"), label)
    bases = broadcast_if_small(staged, _BROADCAST_BLOCKS)
    same = F.shiftright(df[last].cast("bigint"), _BLOCK_BITS) == bases["_block"]
    for c in key:
        same = same & df[c].eqNullSafe(bases[c])
    at = df[last].cast("bigint").bitwiseAND((1 << _BLOCK_BITS) - 1).cast("int")
    whole = F.shiftright(at, 3)
    cut = F.conv(F.hex(F.substring("_bits", whole + 1, F.lit(1))), 16, 10).cast("int")
    under = F.pow(F.lit(2), at.bitwiseAND(7)).cast("int") - 1
    below = F.bitmap_count(F.substring("_bits", F.lit(1), whole)) + F.bit_count(cut.bitwiseAND(under))
    place = F.when(F.col("_bits").isNull(), df[last].cast("bigint") - F.col("_low")).otherwise(below)
    return df.join(bases, same).select(*[df[c] for c in df.columns], (F.col("_base") + place).alias(name))
