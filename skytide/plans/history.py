"""Attach to each measurement the measurements that came before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skytide.operators.numbering import number_rows
from skytide.session import broadcast_if_small

HOT_ROWS = 200_000


def attach_history(
    df: DataFrame,
    key: str,
    order: list[str],
    fields: list[str],
    depth: int,
    name: str = "history",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Array of the previous ``depth`` rows of the same key, oldest first, null
    when there is none.

    Keys with more than ``hot_rows`` rows are cut into blocks of that size, each
    block led by copies of the ``depth`` rows before it, so no task ever holds
    more than one block of one key.
    """
    item = F.struct(*fields)

    def windowed(frame: DataFrame, group: list[str]) -> DataFrame:
        recent = W.partitionBy(*group).orderBy(*order).rowsBetween(-depth, -1)
        past = F.collect_list(item).over(recent)
        return frame.withColumn(name, F.when(F.size(past) > 0, past))

    hot = df.groupBy(key).count().filter(F.col("count") > hot_rows).select(key)
    if hot.isEmpty():
        return windowed(df, [key])
    hot = broadcast_if_small(hot)
    usual = windowed(df.join(hot, key, "left_anti"), [key])

    numbered = number_rows(df.join(hot, key, "left_semi"), [key], order, "_n", "hot-history")
    block = F.floor(F.col("_n") / hot_rows)
    leads_next = F.col("_n") % hot_rows >= hot_rows - depth
    copies = F.when(leads_next, F.array(block, block + 1)).otherwise(F.array(block))
    cut = numbered.withColumn("_block", F.explode(copies))
    whole = windowed(cut, [key, "_block"]).filter(F.col("_block") == block)
    return usual.unionByName(whole.select(*usual.columns))
