"""Hard negatives by an exact search of an inverted multi-index.

Every vector is cut in two halves. A codebook for each half, fitted to at most
``SAMPLE`` vectors, names its nearest word; the two words of a vector are its cell,
and every row is filed under its cell, in blocks of about ``BLOCK_ROWS`` rows. For a
query, a word bounds the half scores of its rows: the score of the centre plus the
length of the query's half times the word's radius. A heap walks the two sorted lists
of half bounds and visits cells by falling sum. What is sought are the best rows of
score *windows*: an anchor's positives are the best of one unbounded window, the
negatives of a positive those of a window below the positive's score. The walk stops
once no unvisited cell can change a window; a cell that lies above all windows, by
its lower bound, is passed over. So the results are those of a full search.

The walk goes in rounds of growing numbers of cells: requests (up to ``PACK`` anchors
with a cell in common are one row) meet the blocks in a join, scores of a block with
its anchors are one matrix product, and each anchor's best rows decide whether it
goes on. Blocks of one cell are dealt to shelves of ``SHELF`` blocks, so a cell with
a third of all rows is many keys. What the driver holds is bounded by the
parameters: the codebooks and one row for each of at most ``WORDS * WORDS`` cells.

Scores are exact integers: components are ``floor(scale * x)``. Rows with a null
label or vector or a null or non-finite component take no part; vectors of different
lengths do not meet. Higher scores come first, ties by smaller id (null last).
Repeated rows are rows of their own, also as anchors. No rows give no rows; extra
columns are ignored. Components too large for exact scores in 64 bits are an error.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skytide.session import stage

SAMPLE = 4096
WORDS = 256
CELL_ROWS = 1024
BLOCK_ROWS = 2048
SHELF = 16
PACK = 256
FIRST_CELLS = 8
_NO_ID = (1 << 63) - 1
_FAR = 1 << 62


# -- codebooks ----------------------------------------------------------------
def codebook(rows: np.ndarray, n_words: int, turns: int = 8) -> np.ndarray:
    """Centres of ``rows`` by Lloyd's method; the rows come in random order."""
    centres = np.unique(rows, axis=0) if len(rows) <= n_words else rows[:n_words].copy()
    for _ in range(turns):
        own = nearest(rows, centres)
        for word in np.unique(own):
            centres[word] = rows[own == word].mean(axis=0)
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T, axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), width)


def _files(width: int, books: tuple[np.ndarray, np.ndarray]):
    """Adds the cell and the distances from its two centres to batches of vectors."""
    half = width // 2

    def run(batches):
        for batch in batches:
            rows = _matrix(batch.column("v"), width)
            words, far = [], []
            for part, book in zip((rows[:, :half], rows[:, half:]), books):
                words.append(nearest(part, book))
                far.append(np.sqrt(((part - book[words[-1]]) ** 2).sum(axis=1)))
            cell = words[0].astype(np.int64) * len(books[1]) + words[1]
            arrays = [batch.column(c) for c in ("uid", "id", "label", "v")]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(cell), pa.array(far[0]), pa.array(far[1])], ["uid", "id", "label", "v", "cell", "far1", "far2"])

    return run


def _pack_block(rows: pa.Table) -> pa.Table:
    uid, ids = (np.asarray(rows.column(c)).astype(np.int64) for c in ("uid", "id"))
    matrix = np.asarray(rows.column("v").combine_chunks().flatten()).astype(np.int64)
    out = [rows.column("shelf")[:1], [uid.tobytes()], [ids.tobytes()], [rows.column("label").to_pylist()], [matrix.tobytes()]]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary()]
    return pa.table([pa.array(c, t) if isinstance(c, list) else c.cast(t) for c, t in zip(out, types)], ["shelf", "uids", "ids", "labels", "matrix"])


@dataclass(frozen=True)
class Index:
    width: int
    exact_in_double: bool
    books: tuple[np.ndarray, np.ndarray]
    cells: dict[tuple[int, int], tuple[float, float, list[int]]]  # words to radii and shelves
    radii: tuple[np.ndarray, np.ndarray]
    blocks: DataFrame


def build_index(rows: DataFrame, width: int) -> Index:
    """File all rows (``uid, id, label, v`` of one length) in blocks of cells."""
    half = width // 2
    largest = F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))))
    n, peak = rows.agg(F.count(F.lit(1)), largest).first()
    reach = width * (peak or 0) ** 2
    if reach >= 1 << 62:
        raise ValueError("vector components are too large for exact scores")
    n_words = min(WORDS, max(1, round((n / CELL_ROWS) ** 0.5)))
    sample = rows.orderBy(F.xxhash64("id", "v"), "uid").limit(SAMPLE).select("v").toArrow()
    vectors = _matrix(sample.column("v").combine_chunks(), width)
    books = codebook(vectors[:, :half], n_words), codebook(vectors[:, half:], n_words)
    filed = rows.mapInArrow(_files(width, books), "uid bigint, id bigint, label string, v array<bigint>, cell bigint, far1 double, far2 double")
    filed = stage(filed, "filed-vectors")
    counted = filed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far1").alias("r1"), F.max("far2").alias("r2"))
    cells, shelf_of, radii = {}, [], (np.zeros(len(books[0])), np.zeros(len(books[1])))
    n_shelves = 0
    for r in counted.orderBy("cell").collect():  # at most WORDS * WORDS rows
        i, j = divmod(r.cell, len(books[1]))
        n_blocks = -(-r.n // BLOCK_ROWS)
        shelves = list(range(n_shelves, n_shelves + -(-n_blocks // SHELF)))
        shelf_of.append((r.cell, n_blocks, n_shelves))
        n_shelves += len(shelves)
        cells[i, j] = (r.r1, r.r2, shelves)
        radii[0][i], radii[1][j] = max(radii[0][i], r.r1), max(radii[1][j], r.r2)
    places = rows.sparkSession.createDataFrame(pa.table(dict(zip(("cell", "n_blocks", "shelf"), zip(*shelf_of)))))
    placed = filed.join(F.broadcast(places), "cell")  # as many rows as there are cells
    block = F.pmod(F.xxhash64("uid"), F.col("n_blocks"))
    placed = placed.withColumn("block", block).withColumn("shelf", F.col("shelf") + F.floor(F.col("block") / SHELF))
    packed = placed.select("uid", "id", "label", "v", "cell", "block", "shelf").groupBy("cell", "block").applyInArrow(
        _pack_block, "shelf bigint, uids binary, ids binary, labels array<string>, matrix binary"
    )
    return Index(width, reach < 1 << 53, books, cells, radii, stage(packed, "vector-blocks"))


# -- the walk -----------------------------------------------------------------
def falling_cells(first: np.ndarray, second: np.ndarray):
    """Pairs of places in two lists by falling sum, with that sum (multi-sequence heap)."""
    one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[one], second[two]
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(one[i]), int(two[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def wanted_cells(query: np.ndarray, needs: list[int], high: int, index_parts, seen: int, n_cells: int):
    """The shelves to visit after ``seen`` cells, and whether the walk must go on after them.

    ``needs`` holds per window the least score that still changes it; rows above ``high`` are in no window."""
    width, books, cells, radii = index_parts
    need = min(needs, default=_FAR)
    halves = query[: width // 2], query[width // 2 :]
    norm = [float(np.sqrt((h**2).sum())) for h in halves]
    centre = [book @ h for book, h in zip(books, halves)]
    bound = [c + n * r for c, n, r in zip(centre, norm, radii)]
    slack = 1e-9 * (1 + sum(float(np.abs(c).max(initial=0)) + n * float(r.max(initial=0)) for c, n, r in zip(centre, norm, radii)))
    shelves, count = [], 0
    for total, i, j in falling_cells(*bound):
        if total + slack < need:  # certified: nothing that is left reaches a window
            return shelves, False
        if (i, j) not in cells:
            continue
        r1, r2, own = cells[i, j]
        middle, off = centre[0][i] + centre[1][j], norm[0] * r1 + norm[1] * r2
        if middle - off - slack > high:
            continue
        count += 1
        if count > seen + n_cells:
            return shelves, True
        if count > seen and middle + off + slack >= need:
            shelves.extend(own)
    return shelves, False


_REQUEST = pa.schema([("shelf", pa.int64()), ("anchors", pa.binary()), ("own", pa.list_(pa.string())), ("queries", pa.binary()), ("windows", pa.binary())])
_REQUEST_DDL = "shelf bigint, anchors binary, own array<string>, queries binary, windows binary"


def _requests(index_parts, seen: int, n_cells: int):
    """Anchors with their windows to rows ``shelf`` and the anchors that want it; shelf -1 says that a walk goes on."""

    def run(batches):
        for batch in (part for b in batches for part in (b.slice(at, PACK) for at in range(0, b.num_rows, PACK))):
            queries = _matrix(batch.column("v"), index_parts[0])
            uid, labels = np.asarray(batch.column("uid")), batch.column("label").to_pylist()
            lows, highs, worst = (batch.column(c).to_pylist() for c in ("lows", "highs", "worst"))
            needs = [[_FAR if a > b else a if w is None else max(a, w) for a, b, w in zip(*x)] for x in zip(lows, highs, worst)]
            wanted: dict[int, list[int]] = {}
            for k in range(len(uid)):
                shelves, more = wanted_cells(queries[k], needs[k], max(highs[k], default=-_FAR), index_parts, seen, n_cells)
                for shelf in shelves + [-1] * more:
                    wanted.setdefault(shelf, []).append(k)
            rows = []
            for shelf, ks in wanted.items():
                if shelf < 0:
                    rows.append((shelf, b"", [], b"", b""))
                    continue
                windows = [x for k in ks for x in zip(needs[k], highs[k])]
                rows.append((shelf, uid[ks].tobytes(), [labels[k] for k in ks], queries[ks].astype(np.int64).tobytes(), np.array(windows, np.int64).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, _REQUEST)], schema=_REQUEST)

    return run


_FOUND_DDL = "uid bigint, window int, score bigint, id bigint, other bigint"
_FOUND = pa.schema([("uid", pa.int64()), ("window", pa.int32()), ("score", pa.int64()), ("id", pa.int64()), ("other", pa.int64())])


def _scores(width: int, in_double: bool, same_label: bool, k: int):
    """Blocks with their anchors to the best ``k`` rows of each window in the block."""
    kind = np.float64 if in_double else np.int64

    def long(value) -> np.ndarray:
        return np.frombuffer(value.as_py(), np.int64)

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(name)[r] for name in batch.schema.names}
                uids, ids, anchors = long(row["uids"]), long(row["ids"]), long(row["anchors"])
                labels, own = np.array(row["labels"].as_py(), object), row["own"].as_py()
                matrix = long(row["matrix"]).reshape(len(uids), width).astype(kind)
                queries = long(row["queries"]).reshape(len(anchors), width).astype(kind)
                windows = long(row["windows"]).reshape(len(anchors), -1, 2)
                scores = (matrix @ queries.T).astype(np.int64)
                found = []
                for a in range(len(anchors)):
                    score, window = scores[:, a], windows[a]
                    fits = (labels == own[a]) == same_label
                    fits &= (uids != anchors[a]) & (score >= window[:, 0].min()) & (score <= window[:, 1].max())
                    at = np.flatnonzero(fits)
                    at = at[np.lexsort((uids[at], ids[at], -score[at]))]
                    for w, (need, high) in enumerate(window):
                        best = at[(score[at] >= need) & (score[at] <= high)][:k]
                        found.append((np.full(len(best), anchors[a]), np.full(len(best), w, np.int32), score[best], ids[best], uids[best]))
                columns = [np.concatenate(c) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_FOUND)

    return run


def best_in_windows(anchors: DataFrame, index: Index, same_label: bool, k: int) -> DataFrame:
    """The best ``k`` rows of every window of ``anchors`` (``uid, label, v, lows, highs``):
    ``uid, window, score, id, other``, of equal or of different label."""
    parts = (index.width, index.books, index.cells, index.radii)
    best, seen, n_cells = None, 0, FIRST_CELLS
    order = W.partitionBy("uid", "window").orderBy(F.desc("score"), "id", "other")
    while True:
        if best is None:
            state = anchors.withColumn("worst", F.transform("lows", lambda x: F.lit(None).cast("bigint")))
        else:
            full = best.groupBy("uid", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
            met = full.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("window", "least"))).alias("met"))
            state = anchors.join(met, "uid", "left").withColumn("worst", F.transform("lows", lambda x, w: F.element_at("met", w)))
        requests = stage(state.select("uid", "label", "v", "lows", "highs", "worst").mapInArrow(_requests(parts, seen, n_cells), _REQUEST_DDL), "requests")
        if requests.isEmpty():
            break
        met = requests.where("shelf >= 0").join(index.blocks, "shelf")
        found = met.mapInArrow(_scores(index.width, index.exact_in_double, same_label, k), _FOUND_DDL)
        found = found if best is None else found.unionByName(best)
        best = stage(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place"), "best")
        seen, n_cells = seen + n_cells, 4 * n_cells
    return anchors.sparkSession.createDataFrame([], _FOUND_DDL) if best is None else best


# -- anchors, positives, negatives ----------------------------------------------
def hard_negatives(
    vectors: DataFrame, anchors: Column | str, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    scale: int = 256, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor
    and each of its best rows of equal label, the best rows of other labels whose score is ``low`` to
    ``high`` percent of the positive's."""
    anchors = F.expr(anchors) if isinstance(anchors, str) else anchors
    usable = F.col(label_col).isNotNull() & F.coalesce(F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("id"), F.col(label_col).cast("string").alias("label"),
        F.when(usable, whole).alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"), usable.alias("usable"),
    ).where("usable").drop("usable")
    rows = stage(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    widths = [r.n for r in rows.where("anchor").select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    parts = [_of_width(rows.where(F.size("v") == n), n, n_positives, n_negatives, low, high) for n in widths]
    if not parts:
        schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return vectors.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.withColumns({c: F.when(F.col(c) != _NO_ID, F.col(c)) for c in ("anchor_id", "positive_id", "negative_id")})


def _of_width(rows: DataFrame, width: int, n_positives: int, n_negatives: int, low: int, high: int) -> DataFrame:
    index = build_index(rows, width)
    queries = rows.where("anchor").select("uid", "label", "v")
    everything = queries.select("*", F.array(F.lit(-_FAR)).alias("lows"), F.array(F.lit(_FAR)).alias("highs"))
    place = W.partitionBy("uid").orderBy(F.desc("score"), "id", "other")
    positives = best_in_windows(everything, index, True, n_positives).withColumn("window", F.row_number().over(place) - 1)
    positives = positives.select("uid", "window", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    positives = positives.withColumns({
        "low": F.ceil(F.lit(low) * F.col("positive_score") / 100).cast("bigint"),
        "high": F.floor(F.lit(high) * F.col("positive_score") / 100).cast("bigint"),
    })
    positives = stage(positives, "positives")
    listed = F.array_sort(F.collect_list(F.struct("window", "low", "high")))
    windows = positives.groupBy("uid").agg(listed.alias("w")).select("uid", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    negatives = best_in_windows(stage(queries.join(windows, "uid"), "windows"), index, False, n_negatives)
    place = W.partitionBy("uid", "window").orderBy(F.desc("score"), "id", "other")
    negatives = negatives.select("uid", "window", F.row_number().over(place).alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = rows.where("anchor").select("uid", F.col("id").alias("anchor_id"))
    return negatives.join(positives, ["uid", "window"]).join(ids, "uid").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
