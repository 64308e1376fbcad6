"""Exact n-gram Jaccard join that skips by what sets have in common.

A document's set is its distinct word shingles. Two sets with similarity t or
more share a token among the first ``n - ceil(t n) + 1`` of each in one global
order, so only those prefixes are indexed. Equal sets are one set. The order
puts tokens that are frequent anywhere last (a pre-aggregated count; it steers
the cost, not the result). Then sets related to each other save each other's work:

1. *Centres*: of each list of the index, the set most of whose tokens are
   frequent is the centre, in a family of near copies usually their origin.
   Every set is compared with the centres of its lists; verified links give
   first components.
2. *Answers from a similar set*: members of one component are answered by it and
   are not compared with each other any more. Sets that share a list share its
   centre, so the pairs left are those around a centre: the members outside its
   main component against the others, in blocks of a few hundred sets, two blocks
   of the main component being skipped.
3. *Skipping by position and size*: an entry whose position and size rule out
   enough common tokens with its whole list is skipped, and so are blocks of
   size classes too far apart.
4. Pairs must pass an exact bound on the difference of two sets, the Hamming
   distance of their parity bitmaps, taken block against block, before the sets
   themselves are fetched and intersected.

Entries of frequent tokens do not meet in a bucket but in an aggregation and a
join that Spark can split, so one family may hold a third of all rows. No step
emits the pairs of a family. Tokens are 64-bit hashes of shingles.

A null or empty text has an empty set, linked with nothing; its component is
itself. A component's id is its smallest document id, null ids last. Equal
documents link. No rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytide.llm.blocks import blocks, mix, pack, table_of, unpack, word_hashes
from skytide.llm.components import components
from skytide.session import broadcast_if_small, stage, staging_scope

NGRAM = 5
PERCENT = 75
FREQUENT = 200_000
BUCKET_ENTRIES = 400_000
BLOCK_SETS = 256
_U = np.uint64
_INDEXED = _U(0xFFFFFFFFFFFF0000)  # the index knows tokens by 48 bits; false meetings cost time, not results
_PACKED = ["bucket", "often", "tokens", "owners", "positions", "keys", "sizes", "weights"]
WORD = table_of([(9, 13), (32, 32)], invert=True)


class _Sets:
    """The shingle sets of a block: ``tokens`` sorted within each set, set k at ``first[k]:first[k + 1]``."""

    def __init__(self, block, ngram: int):
        words, doc = word_hashes(block, WORD)
        n_words = np.bincount(doc, minlength=len(block))
        after = np.cumsum(n_words)
        # a shingle starts at each word with enough words after it, or at the first of a short text
        left = after[doc] - np.arange(len(words))
        opens = (left >= ngram) | ((n_words[doc] < ngram) & (left == n_words[doc]))
        at = np.flatnonzero(opens)
        span = np.minimum(left[at], ngram)
        token = np.zeros(len(at), _U)
        for k in range(ngram):
            here = span > k
            token[here] += mix(words[at[here] + k] + _U(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        token = mix(token + span.astype(_U))
        owner = doc[at]
        order = np.lexsort((token, owner))
        token, owner = token[order], owner[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = token[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(block)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        sums = np.zeros(len(self.tokens) + 1, _U)
        np.cumsum(mix(self.tokens ^ _U(0xA5A5A5A5A5A5A5A5)), out=sums[1:])
        self.key = mix(sums[self.first[1:]] - sums[self.first[:-1]] + self.sizes.astype(_U)).view(np.int64)

    def of(self, k: int) -> np.ndarray:
        return self.tokens[self.first[k] : self.first[k + 1]]

    def bitmap(self, k: int) -> bytes:
        """Parity of the tokens in each cell; cells at least as many as the set's size, a power of two."""
        own = self.of(k)
        bits = max(9, (len(own) - 1).bit_length())
        cells = (own >> _U(64 - bits)).astype(np.int64)
        return np.packbits((np.bincount(cells, minlength=1 << bits) & 1).astype(np.uint8)).tobytes()


def _folded(grid: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows of bytes) at a smaller width: neighbouring cells join, parities add."""
    if grid.shape[1] == width:
        return grid
    bits = np.unpackbits(grid, axis=1).reshape(len(grid), width * 8, -1)
    return np.packbits(np.bitwise_xor.reduce(bits, axis=2), axis=1)


class _Bitmaps:
    """Bitmaps of many sets, those of one width as one array."""

    def __init__(self, bits: list[bytes]):
        self.n = len(bits)
        widths = np.array([len(b) for b in bits], np.int64)
        self.grids = {}
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            self.grids[int(width), int(width)] = at, np.frombuffer(b"".join(bits[k] for k in at), np.uint8).reshape(-1, width)

    def difference(self, other: bytes) -> np.ndarray:
        """A lower bound of the size of each symmetric difference with one other set."""
        out = np.zeros(self.n, np.int64)
        single = np.frombuffer(other, np.uint8).reshape(1, -1)
        for width in [w for w, own in self.grids if w == own]:
            common = min(width, single.shape[1])
            if (width, common) not in self.grids:
                at, grid = self.grids[width, width]
                self.grids[width, common] = at, _folded(grid, common)
            at, grid = self.grids[width, common]
            apart = (grid ^ _folded(single, common)).view(_U)
            out[at] = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
        return out


def digests(texts: DataFrame, ngram: int) -> DataFrame:
    """``doc_id, k1, n, key, bitmap`` per document; ``key`` names the set."""

    def digest(batches):
        for batch in batches:
            for block in blocks(batch.column(2)):
                sets, rows = _Sets(block, ngram), batch.slice(block.first, len(block))
                bitmaps = [sets.bitmap(k) if sets.sizes[k] else b"" for k in range(len(block))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(sets.sizes), pa.array(sets.key), pa.array(bitmaps, pa.binary())],
                    ["doc_id", "k1", "n", "key", "bitmap"],
                )

    kind = dict(texts.dtypes)["doc_id"]
    return texts.select("doc_id", "k1", "text").mapInArrow(digest, f"doc_id {kind}, k1 bigint, n bigint, key bigint, bitmap binary")


def frequent_tokens(texts: DataFrame, ngram: int, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Tokens often seen within some batch and their counts, the ``limit`` most frequent."""

    def tally(batches):
        for batch in batches:
            parts = [_Sets(block, ngram).tokens for block in blocks(batch.column(0))]
            tokens, n = np.unique(np.concatenate(parts or [np.zeros(0, _U)]), return_counts=True)
            many = n >= max(4, batch.num_rows // 500)
            yield pa.RecordBatch.from_arrays([pa.array(tokens[many].view(np.int64)), pa.array(n[many])], ["token", "n"])

    counted = texts.select("text").mapInArrow(tally, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "token").limit(limit).collect()
    tokens = np.array([r.token for r in top], np.int64).view(_U)
    order = np.argsort(tokens)
    return tokens[order], np.array([r["n"] for r in top], np.int64)[order]


def _planes(values: np.ndarray) -> bytes:
    """Small numbers as byte planes, most of which are zeros."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def prefix_entries(texts: DataFrame, ngram: int, percent: int, frequent, n_buckets: int) -> DataFrame:
    """The index entries of each distinct set, packed: a row for each block of
    documents and bucket of tokens. ``weights`` says how frequent a set's tokens
    are on average. Entries of frequent tokens form rows of their own."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def index(batches):
        listed, counts = shared.value
        seen: set[int] = set()
        deal = count(TaskContext.get().partitionId() * 7919)
        for batch in batches:
            out = []
            for block in blocks(batch.column(0)):
                sets = _Sets(block, ngram)
                new = np.zeros(len(block), bool)
                for k in np.flatnonzero(sets.sizes):
                    if (key := int(sets.key[k])) not in seen:
                        seen.add(key)
                        new[k] = True
                keep = new[sets.owner]
                token, owner = sets.tokens[keep], sets.owner[keep]
                often = np.zeros(len(token), np.int64)
                if len(listed):
                    at = np.searchsorted(listed, token)
                    at[at == len(listed)] = 0
                    often = np.where(listed[at] == token, counts[at], 0)
                weight = np.bincount(owner, often, len(block)) / np.maximum(sets.sizes, 1)
                order = np.lexsort((token, often, owner))
                token, owner, often = token[order], owner[order], often[order]
                pos = np.arange(len(owner)) - np.searchsorted(owner, owner)
                n = sets.sizes[owner]
                pick = pos < n - (percent * n + 99) // 100 + 1
                token, owner, often, pos = token[pick] & _INDEXED, owner[pick], often[pick] > 0, pos[pick]
                # frequent tokens need no bucket, they meet in a join that Spark can split: they are dealt out
                bucket = np.where(often, next(deal) % n_buckets, ((token >> _U(32)) * _U(n_buckets) >> _U(32)).astype(np.int64))
                order = np.lexsort((token, bucket, often))
                token, owner, pos, bucket, often = token[order], owner[order], pos[order], bucket[order], often[order]
                edges = np.flatnonzero(np.diff(bucket * 2 + often, prepend=-1)) if len(bucket) else []
                for a, b in zip(edges, [*edges[1:], len(bucket)]):
                    docs, local = np.unique(owner[a:b], return_inverse=True)
                    out.append((
                        int(bucket[a]), bool(often[a]), pack(token[a:b]), _planes(local), _planes(pos[a:b]),
                        sets.key[docs].tobytes(), _planes(sets.sizes[docs]), weight[docs].astype(np.float32).tobytes(),
                    ))
            columns = list(zip(*out)) if out else [()] * 8
            types = [pa.int32(), pa.bool_()] + [pa.binary()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _PACKED)

    return texts.select("text").mapInArrow(index, "bucket int, often boolean, " + ", ".join(f"{c} binary" for c in _PACKED[2:]))


def _within_reach(start: np.ndarray, length: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Entries that some other of their list may link with, judged by the list's range
    of positions and sizes: a token at positions i and j leaves at most
    1 + min(i, j) + min(n - 1 - i, m - 1 - j) common tokens."""
    if not len(start):
        return np.zeros(0, bool)
    spread = lambda ends: np.repeat(ends, length)
    low, high = spread(np.minimum.reduceat(pos, start)), spread(np.maximum.reduceat(pos, start))
    small, large = spread(np.minimum.reduceat(n, start)), spread(np.maximum.reduceat(n, start))
    most = 1 + np.minimum(pos, high) + np.minimum(n - 1 - pos, large - 1 - low)
    return most * (100 + percent) >= percent * (n + np.maximum(small, n * percent // 100))


def _lists_of_bucket(table: pa.Table, percent: int) -> pa.Table:
    """Entries of the lists of more than one set, with centre and length; entries of
    frequent tokens as they are."""
    often = np.asarray(table.column("often"))
    out = []
    for kind in (False, True):
        rows = np.flatnonzero(often == kind)
        if not len(rows):
            continue
        part = {c: [table.column(c)[int(r)].as_py() for r in rows] for c in _PACKED[2:]}
        token = np.concatenate([unpack(x) for x in part["tokens"]])
        docs = [np.frombuffer(x, np.int64) for x in part["keys"]]
        base = np.concatenate([[0], np.cumsum([len(d) for d in docs])[:-1]])
        local = np.concatenate([_numbers(x) + k for x, k in zip(part["owners"], base)])
        pos = np.concatenate([_numbers(x) for x in part["positions"]])
        key = np.concatenate(docs)[local]
        n = np.concatenate([_numbers(x) for x in part["sizes"]])[local]
        weight = np.concatenate([np.frombuffer(x, np.float32) for x in part["weights"]])[local]
        centre = m = np.zeros(len(token), np.int64)
        if not kind:
            order = np.lexsort((key, weight, token))
            token, key, n, pos, weight = token[order], key[order], n[order], pos[order], weight[order]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
            token, key, n, pos, weight = token[new], key[new], n[new], pos[new], weight[new]
            lists = lambda: (at := np.flatnonzero(np.diff(token, prepend=token[:1] ^ _U(1))), np.diff(np.append(at, len(token))))
            near = _within_reach(*lists(), n, pos, percent)
            token, key, n, pos, weight = token[near], key[near], n[near], pos[near], weight[near]
            start, length = lists()
            centre, m = np.repeat(key[start + length - 1], length), np.repeat(length, length)
            several = m > 1
            token, key, n, pos, weight, centre, m = (x[several] for x in (token, key, n, pos, weight, centre, m))
        out.append(pa.table(
            [pa.array(token.view(np.int64)), pa.array(key), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(weight),
             pa.array(centre, pa.int64()), pa.array(m, pa.int64()), pa.array(np.full(len(token), kind))],
            ["token", "key", "n", "pos", "weight", "centre", "m", "often"],
        ))
    return pa.concat_tables(out)


def shared_lists(entries: DataFrame, percent: int) -> DataFrame:
    """``token, key, n, pos, centre, m``: the entries of lists of more than one set,
    with the list's centre and length."""
    schema = "token bigint, key bigint, n int, pos int, weight float, centre bigint, m bigint, often boolean"
    lists = stage(entries.groupBy("bucket").applyInArrow(lambda table: _lists_of_bucket(table, percent), schema), "lists")
    often = lists.where("often").select("token", "key", "n", "pos", "weight")
    best = often.groupBy("token").agg(
        F.max(F.struct("weight", "key")).alias("best"), F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("m")
    )
    best = best.where("low <> high").select("token", F.col("best.key").alias("centre"), "m")
    names = ["token", "key", "n", "pos", "centre", "m"]
    return lists.where("not often").select(*names).unionByName(often.join(best, "token").select(*names))


def _may_link(n: np.ndarray, bits: _Bitmaps, other_n: int, other_bits: bytes, percent: int) -> np.ndarray:
    """Which sets' sizes and bitmaps allow the similarity with one other set."""
    least, total = bits.difference(other_bits), n + other_n
    # with d different tokens: (total - d) / (total + d) at most is the similarity
    fits = 100 * (total - least) >= percent * (total + least)
    return fits & (100 * np.minimum(n, other_n) >= percent * np.maximum(n, other_n))


def _pairs_of(ends: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    x, y = (np.concatenate(c) for c in zip(*ends)) if ends else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def members_of_centres(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``centre, key, n, bitmap, size_class, more``: the sets around each centre, once
    each. Two sets that share a list share its centre. Sets of similarity t lie in
    the same or neighbouring size classes; ``more`` tells lists with a third set."""
    around = lists.groupBy("centre", "key").agg(F.max(F.col("m") > 2).alias("more"))
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent))) + 1e-9)
    return around.join(sets.select("key", "n", "bitmap"), "key").withColumn("size_class", size_class)


def _in_blocks(members: DataFrame, groups: list[str]) -> DataFrame:
    """Rows of a group in blocks of about ``BLOCK_SETS``, each one row."""
    sizes = members.groupBy(*groups).agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("parts"))
    dealt = members.join(sizes, groups).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    entry = F.struct("key", "n", "bitmap", *([F.col("root")] if "root" in members.columns else []))
    return dealt.groupBy(*groups, "part").agg(F.collect_list(entry).alias("entries"))


def _star_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every set with the centres of its lists, as far as sizes and bitmaps allow a link."""
    centre = sets.select(F.col("key").alias("centre"), F.col("n").alias("cn"), F.col("bitmap").alias("cbits"))
    rows = _in_blocks(members.where("key <> centre"), ["centre"]).join(centre, "centre").select("centre", "cn", "cbits", "entries")

    def compare(batches):
        for batch in batches:
            out = []
            for centre, n, bits, entries in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3)):
                e = entries.values
                keys = np.asarray(e.field("key"))
                keys = keys[_may_link(np.asarray(e.field("n")), _Bitmaps(e.field("bitmap").to_pylist()), n, bits, percent)]
                out.append((keys, np.full(len(keys), centre, np.int64)))
            yield _pairs_of(out)

    return rows.mapInArrow(compare, "a bigint, b bigint").distinct()


def _rest(members: DataFrame, root: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components around one centre that sizes and bitmaps still
    allow. Members of a centre's main component lie in blocks of their own, and two
    such blocks are skipped, as are blocks of size classes too far apart."""
    named = members.where("more").join(root.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    named = stage(named, "around")
    counted = named.groupBy("centre", "root").agg(F.count(F.lit(1)).alias("c"))
    main = counted.groupBy("centre").agg(F.max(F.struct("c", "root")).alias("m"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    open_ = named.join(main.select("centre", F.col("m.root").alias("main")), "centre").withColumn("is_main", F.col("root") == F.col("main"))
    blocked = _in_blocks(open_, ["centre", "is_main", "size_class"])
    blocked = stage(blocked.withColumn("block", F.struct("is_main", "size_class", "part")), "blocks")
    one, two = blocked.alias("x"), blocked.alias("y")
    pairs = one.join(two, F.col("x.centre") == F.col("y.centre")).where(
        ~F.col("x.is_main")
        & (F.abs(F.col("x.size_class") - F.col("y.size_class")) <= 1)
        & (F.col("y.is_main") | (F.col("x.block") <= F.col("y.block")))
    )

    def compare(batches):
        for batch in batches:
            out = []
            for left, right in zip(batch.column(0), batch.column(1)):
                x, y = left.values, right.values
                keys, n, root_ = (np.asarray(y.field(c)) for c in ("key", "n", "root"))
                bits = _Bitmaps(y.field("bitmap").to_pylist())
                for one_key, one_n, one_bits, one_root in zip(*(x.field(c).to_pylist() for c in ("key", "n", "bitmap", "root"))):
                    other = keys[(root_ != one_root) & _may_link(n, bits, one_n, one_bits, percent)]
                    out.append((other, np.full(len(other), one_key, np.int64)))
            yield _pairs_of(out)

    return pairs.select(F.col("x.entries").alias("left"), F.col("y.entries").alias("right")).mapInArrow(compare, "a bigint, b bigint").distinct()


def _links(pairs: DataFrame, sets: DataFrame, texts: DataFrame, ngram: int, percent: int) -> DataFrame:
    """The pairs that do link, decided on the sets themselves."""
    with staging_scope():
        return stage(_linked(pairs, sets, texts, ngram, percent), "links", keep=True)


def _linked(pairs: DataFrame, sets: DataFrame, texts: DataFrame, ngram: int, percent: int) -> DataFrame:
    pairs = stage(pairs, "maybe")
    keys = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = stage(sets.join(keys, "key").select("k1"), "wanted")

    def tokens(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, packed = [], []
            for block in blocks(batch.column(0)):
                own = _Sets(block, ngram)
                for k in range(len(block)):
                    if own.sizes[k] and int(own.key[k]) not in seen:
                        seen.add(int(own.key[k]))
                        keys.append(int(own.key[k]))
                        packed.append(pack(own.of(k)))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(packed, pa.binary())], ["key", "tokens"])

    fetched = texts.join(broadcast_if_small(wanted), "k1", "left_semi").select("text").mapInArrow(tokens, "key bigint, tokens binary")
    fetched = stage(fetched.groupBy("key").agg(F.first("tokens").alias("tokens")), "tokens")

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = unpack(x.as_py()), unpack(y.as_py())
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    a = fetched.select(F.col("key").alias("a"), F.col("tokens").alias("ta"))
    b = fetched.select(F.col("key").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(compare, "a bigint, b bigint")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM, percent: int = PERCENT
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``, and ``k1``, the hash
    of the text, and ``root``, the same for all texts of a component. Documents link when 100 * intersection >= ``percent`` * union."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"))
    with staging_scope():
        named = stage(_named(texts, ngram, percent), "named", keep=True)
    smallest = named.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    return named.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"), "k1", "root"
    )


def _named(texts: DataFrame, ngram: int, percent: int) -> DataFrame:
    """``doc_id, k1, n, key, root`` per document. What a step has staged goes with the step."""
    rows = stage(digests(texts, ngram), "digests")
    sets = rows.where("n > 0").groupBy("key").agg(F.first("n").alias("n"), F.min(F.struct("k1", "bitmap")).alias("one"))
    sets = stage(sets.select("key", "n", F.col("one.k1").alias("k1"), F.col("one.bitmap").alias("bitmap")), "sets")
    frequent = frequent_tokens(texts, ngram)
    n_buckets = 1 + int((sets.agg(F.sum("n")).first()[0] or 0) * (100 - percent) / 100) // BUCKET_ENTRIES
    with staging_scope():
        lists = shared_lists(prefix_entries(texts, ngram, percent, frequent, n_buckets), percent)
        members = stage(members_of_centres(lists, sets, percent), "members", keep=True)
    first = _links(_star_pairs(members, sets, percent), sets, texts, ngram, percent)
    with staging_scope():
        second = stage(_links(_rest(members, components(first), percent), sets, texts, ngram, percent), "second", keep=True)
    root = components(first.unionByName(second)).withColumnRenamed("node", "key")
    return rows.drop("bitmap").join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
