"""Benchmark decontamination with a distributed positional inverted index.

1. Benchmark texts become windows of ``width`` consecutive words.
2. One pass over the documents counts how often each benchmark word occurs.
3. Each window keeps its two rarest words; a second pass writes the postings
   (text, position) of those words only.
4. Postings are shifted by the word's offset in the window; a window is a
   candidate where the shifted lists of its rarest words meet.
5. Candidates are compared word by word with the document: exact phrase
   matches. With ``within``, proximity matches are found besides: two of the
   three rarest different words of a window that occur in the documents at all,
   whether or not its other words do, stand at most so many words apart, in any order.

Words, not texts, travel: the postings of rare words are a small part of the
corpus. Word lists go to the tasks in slices of at most ``slice_terms`` words,
one pass per slice, so the broadcast has a fixed bound whatever the benchmark.

Nulls and empty texts have no words and match nothing. Repeated documents each
get their row; their postings are stored once. A null item id counts as the
empty text. Other columns of the inputs are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skytide.llm.blocks import blocks, table_of, word_hashes
from skytide.session import stage

# A-Z count as their lower case
WORD = table_of([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)], invert=True)
WIDTH = 10
SLICE_TERMS = 1 << 20


def _word_hashes(block):
    hashes, doc = word_hashes(block, WORD)
    first = np.searchsorted(doc, np.arange(len(block) + 1))  # first word of each document
    return hashes.view(np.int64), doc, first


def item_windows(items: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """``words`` (hashes of a window's words) and ``items`` (ids as text), one row per distinct window."""

    def cut(batches):
        for batch in batches:
            ids, words = [], []
            for block in blocks(batch.column(1)):
                hashes, _, first = _word_hashes(block)
                for k in range(len(block)):
                    own = hashes[first[k] : first[k + 1]]
                    for at in range(max(1, len(own) - width + 1) if len(own) else 0):
                        ids.append(batch.column(0)[block.first + k].as_py())
                        words.append(own[at : at + width].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(words, pa.list_(pa.int64()))], ["item", "words"]
            )

    named = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return (
        named.mapInArrow(cut, "item string, words array<bigint>")
        .groupBy("words")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("window", F.xxhash64("words"))
    )


def _slices(terms: DataFrame, slice_terms: int):
    """The distinct terms as sorted arrays of at most about ``slice_terms`` each."""
    terms = stage(terms.distinct(), "terms")
    n_slices = -(-terms.count() // slice_terms) or 1
    for k in range(n_slices):
        part = terms.where(F.pmod(F.xxhash64("term"), F.lit(n_slices)) == k)
        yield np.sort(np.array([r.term for r in part.collect()], np.int64))


def _lookup(terms: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Index into ``terms`` of each hash, or -1."""
    at = np.searchsorted(terms, hashes)
    at[at == len(terms)] = 0
    return np.where(terms[at] == hashes, at, -1) if len(terms) else np.full(len(hashes), -1)


def term_frequencies(texts: DataFrame, terms: DataFrame, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """``term``, ``n``: occurrences of each listed word in all texts (column ``text``)."""
    spark, out = texts.sparkSession, None
    for own in _slices(terms, slice_terms):
        shared = spark.sparkContext.broadcast(own)

        def count(batches):
            listed = shared.value
            total = np.zeros(len(listed), np.int64)
            for batch in batches:
                for block in blocks(batch.column(0)):
                    at = _lookup(listed, _word_hashes(block)[0])
                    total += np.bincount(at[at >= 0], minlength=len(listed))
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(listed[seen]), pa.array(total[seen])], ["term", "n"])

        part = texts.select("text").mapInArrow(count, "term bigint, n bigint")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("term").agg(F.sum("n").alias("n"))


def postings(texts: DataFrame, terms: DataFrame, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """``k1, k2`` (key of the text), ``term``, ``pos``: where the listed words stand."""
    spark, out = texts.sparkSession, None
    for own in _slices(terms, slice_terms):
        shared = spark.sparkContext.broadcast(own)

        def index(batches):
            listed = shared.value
            for batch in batches:
                seen = set()
                k1, k2 = np.asarray(batch.column(0)), np.asarray(batch.column(1))
                for block in blocks(batch.column(2)):
                    hashes, doc, first = _word_hashes(block)
                    at = _lookup(listed, hashes)
                    hit = np.flatnonzero(at >= 0)
                    rows = doc[hit] + block.first
                    # one set of postings for equal texts of a batch
                    new = np.ones(len(block), bool)
                    for row in np.unique(rows):
                        key = (k1[row], k2[row])
                        new[row - block.first] = key not in seen
                        seen.add(key)
                    kept = new[doc[hit]]
                    hit, rows = hit[kept], rows[kept]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k1[rows]), pa.array(k2[rows]), pa.array(listed[at[hit]]), pa.array((hit - first[doc[hit]]).astype(np.int32))],
                        ["k1", "k2", "term", "pos"],
                    )

        part = texts.select("k1", "k2", "text").mapInArrow(index, "k1 bigint, k2 bigint, term bigint, pos int")
        out = part if out is None else out.unionByName(part)
    return out


def rarest_slots(windows: DataFrame, frequencies: DataFrame, slots: int = 2) -> DataFrame:
    """``window, term, offset, slot, need``: the rarest words of each window that
    can occur at all, i.e. whose every word occurs in the documents."""
    each = windows.select("window", F.posexplode("words").alias("offset", "term"))
    known = each.join(frequencies, "term", "left")
    by_window = W.partitionBy("window")
    return (
        known.withColumn("missing", F.count_if(F.col("n").isNull()).over(by_window))
        .withColumn("slot", F.row_number().over(by_window.orderBy("n", "offset")) - 1)
        .withColumn("need", F.least(F.lit(slots), F.count(F.lit(1)).over(by_window)).cast("int"))
        .where((F.col("missing") == 0) & (F.col("slot") < slots))
        .select("window", "term", "offset", "slot", "need")
    )


def near_pairs(windows: DataFrame, frequencies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two of the three rarest different words of every window, of those that occur: one
    changed word leaves a pair. ``window, term, slot, need`` once for each pair, whose
    name is ``window``, and ``window, items``."""
    each = windows.select(F.col("window").alias("of"), "items", F.explode(F.array_distinct("words")).alias("term"))
    ranked = each.join(frequencies, "term").withColumn("slot", F.row_number().over(W.partitionBy("of").orderBy("n", "term")))
    rare = ranked.where("slot <= 3").groupBy("of").agg(F.array_sort(F.collect_list("term")).alias("t"), F.first("items").alias("items"))
    two = [F.array(F.get("t", F.lit(x)), F.get("t", F.lit(y))) for x, y in ((0, 1), (0, 2), (1, 2))]
    pairs = rare.select("items", F.explode(F.array(*two)).alias("terms")).where("terms[0] is not null and terms[1] is not null")
    pairs = stage(pairs.withColumn("window", F.xxhash64("terms")), "near_pairs")
    named = pairs.select("window", F.explode("items").alias("item")).groupBy("window").agg(F.collect_set("item").alias("items"))
    chosen = pairs.select("window", "terms").distinct().select("window", F.posexplode("terms").alias("slot", "term"), F.lit(2).alias("need"))
    return chosen, named


def phrase_candidates(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """``k1, k2, window, start`` where the shifted postings of all chosen words of a window meet."""
    return (
        index.join(chosen, "term")
        .withColumn("start", F.col("pos") - F.col("offset"))
        .where("start >= 0")
        .groupBy("k1", "k2", "window", "start")
        .agg(F.expr("bit_or(shiftleft(1, slot))").alias("met"), F.max("need").alias("need"))
        .where("met = shiftleft(1, need) - 1")
        .select("k1", "k2", "window", "start")
    )


def proximity_matches(index: DataFrame, chosen: DataFrame, within: int) -> DataFrame:
    """``k1, k2, window``: texts where the two rarest words of a window stand at most ``within`` words apart."""
    met = index.join(chosen.where("need = 2"), "term").select("k1", "k2", "window", "slot", "pos").distinct()
    # words of one cell of ``within`` positions, or of two neighbouring cells, may be near
    cells = met.withColumn("cell", F.explode(F.array((F.col("pos") / within).cast("int"), (F.col("pos") / within).cast("int") + 1)))
    order = W.partitionBy("k1", "k2", "window", "cell").orderBy("pos")
    last = lambda slot: F.last(F.when(F.col("slot") == slot, F.col("pos")), ignorenulls=True).over(order)
    near = cells.withColumn("gap", F.abs(last(0) - last(1)))
    return near.where(F.col("gap") <= within).select("k1", "k2", "window").distinct()


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(1)).alias("k2")
    )


def find_contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, slice_terms: int = SLICE_TERMS, within: int | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated,
    items, k1`` (``k1``: hash of the text). With ``within`` also ``n_near, near_items``: the
    items of which a window is near, but none is held exactly."""
    texts = keyed(docs, id_col, text_col)
    windows = stage(item_windows(items, item_id, item_text, width), "windows")
    frequencies = term_frequencies(texts, windows.select(F.explode("words").alias("term")), slice_terms)
    chosen = stage(rarest_slots(windows, frequencies), "slots")
    terms = chosen.select("term")
    if within is not None:
        pairs, pair_items = near_pairs(windows, frequencies)
        terms = terms.unionByName(pairs.select("term"))
    index = postings(texts, terms, slice_terms)
    if within is not None:
        index = stage(index, "postings")
    found = (
        phrase_candidates(index, chosen)
        .join(windows, "window")
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("start", "words", "items")).alias("found"))
    )
    # Few texts have candidates: their side is built, the texts stream past.
    joined = texts.join(stage(found, "candidates").hint("shuffle_hash"), ["k1", "k2"], "left")
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, k1 bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, items array<string>"
    if within is None:
        return joined.select("doc_id", "k1", "text", "found").mapInArrow(_verify, schema)
    met = proximity_matches(index, pairs, within).join(pair_items, "window").select("k1", "k2", F.explode("items").alias("item"))
    near = stage(met.groupBy("k1", "k2").agg(F.collect_set("item").alias("near")), "near")
    joined = joined.join(near.hint("shuffle_hash"), ["k1", "k2"], "left")
    checked = joined.select("doc_id", "k1", "text", "found", "near").mapInArrow(_verify, schema + ", near array<string>")
    others = F.array_sort(F.array_except(F.coalesce("near", F.array().cast("array<string>")), "items"))
    return checked.withColumn("near_items", others).withColumn("n_near", F.size("near_items").cast("bigint")).drop("near")


def _verify(batches):
    for batch in batches:
        n = batch.num_rows
        words, hits = np.zeros(n, np.int64), np.zeros(n, np.int64)
        items: list[list[str]] = [[] for _ in range(n)]
        found = batch.column(3)
        some = np.asarray(found.is_valid())
        for block in blocks(batch.column(2)):
            hashes, _, first = _word_hashes(block)
            words[block.first : block.first + len(block)] = np.diff(first)
            for k in np.flatnonzero(some[block.first : block.first + len(block)]):
                own = hashes[first[k] : first[k + 1]]
                covered, matched = np.zeros(len(own), bool), set()
                for one in found[int(block.first + k)].as_py():
                    window = np.array(one["words"], np.int64)
                    at = slice(one["start"], one["start"] + len(window))
                    if np.array_equal(own[at], window):
                        covered[at] = True
                        matched.update(one["items"])
                hits[block.first + k] = covered.sum()
                items[block.first + k] = sorted(matched)
        digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(words), pa.array(hits), pa.array([len(x) for x in items], pa.int64()),
             pa.array(digest, pa.string()), pa.array(hits > 0), pa.array(items, pa.list_(pa.string())), *batch.columns[4:]],
            ["doc_id", "k1", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", *batch.schema.names[4:]],
        )
