"""Connected components of a graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytide.session import stage, staging_scope

JUMPS = 3


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``); the root is the component's smallest node.

    Each round points every node to its smallest neighbour, follows the
    pointers a few steps and renames the ends of all edges; edges within one
    node go. At least half of the nodes go each round, so the rounds grow with
    the logarithm of the nodes. Every round is written out, nothing is
    collected; a node with very many edges is one key of a join that Spark can
    split. Null ends are ignored.
    """
    with staging_scope():
        return stage(_contracted(edges), "components", keep=True)


def _contracted(edges: DataFrame) -> DataFrame:
    left = stage(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    maps: list[DataFrame] = []
    while not left.isEmpty():
        ends = left.select(F.col("b").alias("node"), F.col("a").alias("near")).unionByName(left.select(F.col("a").alias("node"), F.col("b").alias("near")))
        up = ends.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("root"))
        up = stage(up, "pointers")
        for _ in range(JUMPS):
            further = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            up = up.join(further, "root").select("node", F.col("next").alias("root"))
        up = stage(up, "pointers")
        maps.append(up)
        a, b = up.select(F.col("node").alias("a"), F.col("root").alias("ra")), up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        renamed = left.join(a, "a").join(b, "b").where("ra <> rb")
        left = stage(renamed.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).where(F.lit(False))
    out = maps[0]
    for later in maps[1:]:
        step = later.select(F.col("node").alias("root"), F.col("root").alias("next"))
        out = out.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return out
