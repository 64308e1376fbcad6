"""Near-duplicate embeddings by NN-descent.

Equal vectors of a label are one node. The neighbour graph starts from sorted
random projections (vectors next to each other in one of several orders are
first neighbours) and is refined by local joins: the neighbours of a node, in
both directions, are compared with each other, which finds neighbours of
neighbours. A pair stays if it reaches the threshold or is among the nearest of
one of its ends.

A node all of whose list lies above the threshold is *saturated*: its list is
enlarged without limit (every pair above the threshold stays in the graph), and
each round joins another random part of it. The search has to connect a family,
not to meet all of its pairs: the links of a component are then counted exactly,
its members compared block against block, whatever its size; pairs are not kept.

An audit compares stated query vectors, half of them with neighbours above the
threshold, with all others exactly; a true link is held if its ends are in one
component. Rounds go on until the audit finds the wanted recall and the
components stop growing, however many it takes. A search that stands still
below the recall starts from new projections; after ``RESTARTS`` of these, all
vectors of a label are compared with each other.

Cosines are in double precision, of the stored components; no link is below the
threshold. Links between components are searched, so some may be missed;
``audit`` measures how many, and ``near_links`` returns it.

Null labels and vectors, zero vectors and ones with null or non-finite components
link with nothing; neither do vectors of different lengths. Repeated rows link
with each other. A component's id is its smallest id, null ids last. No rows
give no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skytide.llm.components import components
from skytide.session import stage

THRESHOLD = 0.98
NEAREST = 8
ORDERS = 12
NEXT = 4
PART = 48
QUERIES = 512
RECALL = 0.98
RESTARTS = 3
BLOCK = 1024
DEALT = 4096


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(v.values, np.float64) for v in column]


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def usable(embedding, label):
    """A label, and a vector with only finite components, not all zero."""
    real = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return label.isNotNull() & F.coalesce(real & F.exists(embedding, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``node, group, vec, members``: a node per different vector of a label (and length)."""
    vec = F.transform("embedding", lambda x: x.cast("double") + 0.0)
    group = F.xxhash64("label", F.size("embedding"))
    named = rows.where("usable").select(F.col("node"), group.alias("group"), vec.alias("vec"))
    return named.groupBy("node").agg(F.first("group").alias("group"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("members"))


def _first_neighbours(nodes: DataFrame, orders: int, bits: int, first: int = 0) -> DataFrame:
    """Pairs next to each other in one of several orders: each by the signs of ``bits``
    random projections, then by another one. All orders share one sort; ``first`` numbers them."""

    def project(batches):
        for batch in batches:
            vectors = _vectors(batch.column(2))
            for order in range(first, first + orders):
                sign, along = np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
                for size in {len(v) for v in vectors}:
                    planes = np.random.default_rng([order, size]).standard_normal((size, bits + 1))
                    at = [k for k, v in enumerate(vectors) if len(v) == size]
                    seen = _unit(np.stack([vectors[k] for k in at])) @ planes
                    sign[at], along[at] = (seen[:, :bits] > 0) @ (1 << np.arange(bits)), seen[:, bits]
                numbered = pa.array(np.full(len(vectors), order, np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns, numbered, pa.array(sign), pa.array(along)], ["node", "group", "vec", "order", "sign", "along"])

    def link(batches):
        rest = None
        for batch in batches:
            table = batch if rest is None else pa.concat_batches([rest, batch])
            names, groups, order = (np.asarray(table.column(c)) for c in (0, 1, 3))
            vectors, first = _vectors(table.column(2)), 0 if rest is None else len(rest)
            found = []
            for step in range(1, NEXT + 1):
                at = np.flatnonzero((groups[step:] == groups[:-step]) & (order[step:] == order[:-step])) if len(names) > step else np.zeros(0, int)
                at = at[at + step >= first]
                if len(at):
                    cos = np.array([x @ y / np.sqrt((x @ x) * (y @ y)) for x, y in ((vectors[k], vectors[k + step]) for k in at)])
                    found.append((names[at], names[at + step], cos))
            rest = table.slice(max(0, table.num_rows - NEXT))
            yield _pairs(found)

    seen = nodes.select("node", "group", "vec").mapInArrow(project, "node bigint, group bigint, vec array<double>, order int, sign bigint, along double")
    keys = ["order", "group", "sign", "along", "node"]
    placed = seen.repartitionByRange(*keys).sortWithinPartitions(*keys).select("node", "group", "vec", "order")
    return placed.mapInArrow(link, "a bigint, b bigint, cos double")


def _pairs(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Arrays of ends and cosines as one batch, the smaller end first."""
    x, y, cos = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(cos)], ["a", "b", "cos"])


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b", "cos").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "cos"))


def _kept(pairs: DataFrame, threshold: float, nearest: int) -> DataFrame:
    """Different pairs above the threshold, or among the nearest of an end."""
    pairs = pairs.dropDuplicates(["a", "b"])
    near = pairs.where(F.col("cos") >= threshold)
    far = _both_ways(pairs.where(F.col("cos") < threshold)).withColumn("rank", F.row_number().over(W.partitionBy("a").orderBy(F.desc("cos"), "b")))
    far = far.where(F.col("rank") <= nearest).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cos").distinct()
    return near.unionByName(far)


def _local_join(graph: DataFrame, nodes: DataFrame, turn: int, threshold: float, nearest: int) -> DataFrame:
    """Compare neighbours of each node; a saturated node joins another part of its long list each turn."""
    near = F.col("cos") >= threshold
    ways = _both_ways(graph)
    place = F.when(near, F.pmod(F.xxhash64("a", "b", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30) - 2).otherwise(-F.col("cos"))
    ranked = ways.withColumn("rank", F.row_number().over(W.partitionBy("a").orderBy(place, "b")))
    picked = ranked.where(F.when(near, F.col("rank") <= PART).otherwise(F.col("rank") <= 2 * nearest))
    worst = ranked.groupBy("a").agg(F.max(F.when(F.col("rank") >= nearest, -F.col("cos"))).alias("w"))
    held = picked.select(F.col("a").alias("hub"), F.col("b").alias("node"))
    limits = worst.select(F.col("a").alias("node"), (-F.col("w")).alias("least"))
    full = held.join(nodes.select("node", "vec"), "node").join(limits, "node", "left")
    grouped = full.groupBy("hub").agg(F.collect_list(F.struct("node", F.coalesce("least", F.lit(-2.0)).alias("least"), "vec")).alias("list"))

    def compare(batches):
        for batch in batches:
            out = []
            for held_ in batch.column(0):
                rows = held_.values
                if len(rows) < 2:
                    continue
                names = np.asarray(rows.field("node"))
                limit = np.asarray(rows.field("least"))
                vectors = _unit(np.stack(_vectors(rows.field("vec"))))
                cos = vectors @ vectors.T
                i, j = np.triu_indices(len(names), 1)
                value = cos[i, j]
                good = (value >= threshold - 1e-9) | (value > np.minimum(limit[i], limit[j]))
                out.append((names[i[good]], names[j[good]], value[good]))
            yield _pairs(out)

    return grouped.select("list").mapInArrow(compare, "a bigint, b bigint, cos double")


def _truth(nodes: DataFrame, near: DataFrame, threshold: float, queries: int) -> DataFrame:
    """``q, node``: all exact links of the audit's query vectors (``queries`` of them, by
    hash: half of all nodes, half of those with a pair in ``near``)."""
    drawn = lambda rows: rows.orderBy(F.xxhash64("node", F.lit(5)), "node").limit(queries // 2).collect()
    ends = _both_ways(near).select(F.col("a").alias("node")).distinct()
    asked = {r.node: r for rows in (nodes, nodes.join(ends, "node", "left_semi")) for r in drawn(rows)}
    shared = nodes.sparkSession.sparkContext.broadcast([(r.node, r.group, np.array(r.vec)) for r in asked.values()])

    def search(batches):
        by_group: dict[int, list] = {}
        for node, group, vec in shared.value:
            by_group.setdefault(group, []).append((node, vec))
        for batch in batches:
            names, groups, vectors = np.asarray(batch.column(0)), np.asarray(batch.column(1)), _vectors(batch.column(2))
            found = []
            for group, own in by_group.items():
                at = np.flatnonzero(groups == group)
                if len(at):
                    cos = _unit(np.stack([vectors[k] for k in at])) @ _unit(np.stack([v for _, v in own])).T
                    found += [(own[q][0], names[at[k]]) for k, q in zip(*np.nonzero(cos >= threshold)) if own[q][0] != names[at[k]]]
            q, n = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(n, pa.int64())], ["q", "node"])

    return nodes.select("node", "group", "vec").mapInArrow(search, "q bigint, node bigint")


def audit(truth: DataFrame, root: DataFrame) -> float:
    """The share of the queries' true links whose ends are in one component."""
    ends = [root.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in ("q", "node")]
    seen = truth.join(ends[0], "q", "left").join(ends[1], "node", "left")
    total, held = seen.agg(F.count(F.lit(1)), F.count_if(F.col("rq") == F.col("rnode"))).first()
    return held / total if total else 1.0


def _exact(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The links, by the cosine itself: the dot product over the product of the norms."""

    def measure(batches):
        for batch in batches:
            cos = np.array([x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) for x, y in zip(_vectors(batch.column(2)), _vectors(batch.column(3)))])
            good = np.flatnonzero(cos >= threshold)
            yield _pairs([(np.asarray(batch.column(0))[good], np.asarray(batch.column(1))[good], cos[good])])

    border = F.abs(F.col("cos") - threshold) < 1e-6
    x, y = nodes.select(F.col("node").alias("a"), F.col("vec").alias("x")), nodes.select(F.col("node").alias("b"), F.col("vec").alias("y"))
    again = pairs.where(border).join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(measure, "a bigint, b bigint, cos double")
    return pairs.where(~border & (F.col("cos") >= threshold)).unionByName(again)


def _counted(nodes: DataFrame, within: str, threshold: float) -> DataFrame:
    """``node, n`` and ``node, other``: the vectors linked with each of ``nodes`` (with
    ``root``) among all of the same ``within``, and links between two roots, one of
    each two roots at least. Members lie in blocks of about ``BLOCK``, every two of
    which meet in a group; a group takes many small pairs of blocks."""
    sizes = nodes.groupBy(within).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = sizes.select(within, F.ceil(F.col("size") / BLOCK).cast("int").alias("parts"))
    own = nodes.join(sizes, within).withColumn("part", F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")).cast("int"))
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    met = own.withColumn("other", F.explode(other)).select(
        F.col(within).alias("within"), F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "root", "members", "vec"
    )
    n_groups = -(-(own.agg(F.sum("parts")).first()[0] or 0) // DEALT) or 1
    dealt = met.withColumn("deal", F.pmod(F.xxhash64("within", "i", "j"), F.lit(n_groups)))

    def compare(table):
        columns = {c: np.asarray(table.column(c)) for c in ("within", "i", "j", "part", "node", "root", "members")}
        vectors = _vectors(table.column("vec").combine_chunks())
        order = np.lexsort((columns["part"], columns["j"], columns["i"], columns["within"]))
        place = np.stack([columns[c][order] for c in ("within", "i", "j")])
        edges = np.flatnonzero(np.append(True, (place[:, 1:] != place[:, :-1]).any(axis=0)))
        node, n, cross = [], [], []
        for rows in np.split(order, edges[1:]):
            part, name, root, weight = (columns[c][rows] for c in ("part", "node", "root", "members"))
            split = np.searchsorted(part, part[0], side="right")
            same = columns["i"][rows[0]] == columns["j"][rows[0]]
            if split == len(rows) and not same:  # the other block is empty
                continue
            plain = np.stack([vectors[k] for k in rows])
            unit = _unit(plain)
            x, y = (slice(0, len(rows)),) * 2 if same else (slice(0, split), slice(split, len(rows)))
            cos = unit[x] @ unit[y].T
            near = cos >= threshold
            for k, m in zip(*np.nonzero(np.abs(cos - threshold) < 1e-6)):
                u, v = plain[x][k], plain[y][m]
                near[k, m] = u @ v / (np.sqrt(u @ u) * np.sqrt(v @ v)) >= threshold
            if same:
                np.fill_diagonal(near, False)
            node.append(name[x])
            n.append(near @ weight[y])
            if not same:
                node.append(name[y])
                n.append(weight[x] @ near)
            if (root != root[0]).any():
                k, m = np.nonzero(near & (root[x][:, None] != root[y][None, :]))
                _, first = np.unique(np.stack([root[x][k], root[y][m]]), axis=1, return_index=True)
                cross.append((name[x][k[first]], name[y][m[first]]))
        whole = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        a, b = whole([c[0] for c in cross]), whole([c[1] for c in cross])
        node, n = whole(node), whole(n)
        return pa.table({
            "node": pa.array(np.append(node, a)), "n": pa.array(np.append(n, np.zeros(len(a), np.int64))),
            "other": pa.concat_arrays([pa.nulls(len(node), pa.int64()), pa.array(b)]),
        })

    return dealt.groupBy("deal").applyInArrow(compare, "node bigint, n bigint, other bigint")


def near_links(
    nodes: DataFrame, threshold: float = THRESHOLD, nearest: int = NEAREST, orders: int = ORDERS, recall: float = RECALL
) -> tuple[DataFrame, float]:
    """``node, n, root`` of the nodes with links (``n`` counts vectors of other nodes), and the audited recall."""
    largest = nodes.groupBy("group").count().agg(F.max("count")).first()[0] or 0
    bits = int(np.clip(np.log2(max(largest, 1) / 32), 0, 40))
    graph = stage(_kept(_first_neighbours(nodes, orders, bits), threshold, nearest), "graph")
    truth = stage(_truth(nodes, graph.where(F.col("cos") >= threshold), threshold, QUERIES), "audit")
    turn = restarts = tied = 0
    while True:
        more = _local_join(graph, nodes, turn, threshold, nearest)
        graph = stage(_kept(graph.unionByName(more), threshold, nearest), "graph")
        root = components(_exact(graph.where(F.col("cos") >= threshold - 1e-6), nodes, threshold))
        before, tied = tied, root.where("node <> root").count()
        turn, share = turn + 1, audit(truth, root)
        if tied > before * 1.001:
            continue
        if share >= recall or restarts == RESTARTS:
            break
        restarts += 1
        again = _first_neighbours(nodes, orders, bits, first=restarts * orders)
        graph = stage(_kept(graph.unionByName(again), threshold, nearest), "graph")
    named = nodes.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    if share >= recall:
        counted = stage(_counted(named, "root", threshold), "counted")
    else:
        counted, share = stage(_counted(named, "group", threshold), "counted"), 1.0
        across = counted.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
        known = root.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        root = components(known.unionByName(across))
    n = counted.groupBy("node").agg(F.sum("n").alias("n"))
    return n.join(root, "node"), share


def near_components(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, **options
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding"))
    rows = rows.withColumn("usable", usable(F.col("embedding"), F.col("label")))
    # minus zero is zero
    plain = F.transform("embedding", lambda x: x + F.lit(0).cast("float"))
    rows = rows.withColumn("node", F.when(F.col("usable"), F.xxhash64("label", plain)))
    nodes = stage(distinct_vectors(rows), "nodes")
    linked, _ = near_links(nodes, threshold, **options)
    own = (
        nodes.select("node", (F.col("members") - 1).alias("same")).join(linked, "node", "left")
        .select("node", (F.col("same") + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    )
    own = stage(own, "classes")
    slim = rows.select("vec_id", "node").join(own, "node", "left")
    slim = stage(slim, "named")
    smallest = slim.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("smallest"))
    out = slim.join(smallest, "root", "left").withColumn("component_id", F.coalesce("smallest", "vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
