"""Removal of long repeated byte strings by blockwise suffix sorting with a difference cover.

A suffix is *repeated* if its first ``length`` bytes also start elsewhere. Sorting
all suffixes would shuffle the corpus many times over; the difference cover
shrinks what must be sorted:

* The cover ``D`` modulo ``v`` has the property that for any two positions some
  ``k < v`` moves both onto ``D``. So equal ``length``-byte strings share equal
  cover samples inside them.
* Cover samples are ranked first, by two prefixes: ``length - v + 1`` bytes
  (short rank) and ``length + v - 1`` bytes (long rank).
* A suffix without a tied short rank in its first ``v`` positions is unique and
  is not sorted. Where a sample ties in the long rank, the ``v`` suffixes from
  it on are repeated for certain: the long tie is resolved by rank, and only
  the first member of the tie sends its suffixes on, as the others' proxy.
* The remaining suffixes go to buckets, ranges of the sort key; each bucket is
  sorted by itself in one task, and neighbours with equal keys are ties.

Only equality to a fixed depth matters here, so the order sorted by is that of a
64-bit fingerprint of the prefix, not the alphabet; any two of n different
prefixes share a fingerprint with probability n * n / 2^65 in all. Every chunk of documents
sends each key once, with a mark if it has it several times, so a string that
stands in a third of all documents costs one key per chunk. Buckets hold about
``bucket_bytes``, chunks ``chunk_bytes`` (or one longer text). The text is
staged once, bucketed by chunk, and later read without a shuffle.

Nulls count as empty. Repeated rows are documents like others. The id may be
null or repeated and is passed through.
"""

from __future__ import annotations

import hashlib
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytide.llm.blocks import BLOCK_BYTES, Block, Rolling, blocks, byte_values, pack, unpack
from skytide.session import scratch_path, stage

LENGTH = 400
BUCKET_BYTES = 16 << 20
SHORT, LONG, PROXY, SUFFIX = 0, 1, 2, 3
_U = np.uint64
_CUT = _U(0xFFFFFFFFFF000000)  # short ranks only select: 40 bits do, false ties cost time, not results


def difference_cover(limit: int) -> tuple[int, np.ndarray]:
    """The largest period v <= ``limit`` of the Colbourn-Ling family and its cover, 6r + 4 residues."""
    r = 0
    while 24 * (r + 1) ** 2 + 36 * (r + 1) + 13 <= limit:
        r += 1
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.concatenate([[0], np.cumsum(steps)]).astype(np.int64)


class _Chunk:
    """The suffix keys of one chunk of documents."""

    def __init__(self, block: Block, length: int):
        self.block, self.length = block, length
        self.v, cover = difference_cover(length - 16)
        self.rolling = Rolling(byte_values(lower=False)[block.data])
        inside = np.zeros(self.v, bool)
        inside[cover % self.v] = True
        doc = np.repeat(np.arange(len(block)), block.lengths)
        self.start, self.end = block.bounds[:-1][doc], block.bounds[1:][doc]
        at = np.flatnonzero(inside[(np.arange(len(block.data)) - self.start) % self.v])
        room = self.end[at] - at
        self.short_at = at[room >= length - self.v + 1]
        self.long_at = at[room >= length + self.v - 1]

    def short(self):
        return self.rolling.of(self.short_at, self.short_at + (self.length - self.v + 1)) & _CUT

    def long(self):
        return self.rolling.of(self.long_at, self.long_at + (self.length + self.v - 1))

    def _painted(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        n = len(self.block.data)
        steps = np.bincount(first, minlength=n + 1)[: n + 1] - np.bincount(last + 1, minlength=n + 1)[: n + 1]
        return np.cumsum(steps[:n]) > 0

    def resolve(self, ranks: dict[int, np.ndarray]):
        """Suffixes repeated by rank alone, and the positions still to be sorted."""
        tied = self.short_at[_member(self.short(), ranks[SHORT])]
        candidate = self._painted(np.maximum(tied - self.v + 1, self.start[tied]), tied)
        candidate &= self.end - np.arange(len(self.end)) >= self.length
        keys = self.long()
        proxy = _member(keys, ranks[PROXY])
        sure = self.long_at[proxy | _member(keys, ranks[LONG])]
        repeated = self._painted(sure, sure + self.v - 1)
        # the first place of a proxied key in this chunk stands for all others
        first = np.unique(keys[proxy], return_index=True)[1]
        own = self.long_at[proxy][first]
        open_ = candidate & (~repeated | self._painted(own, own + self.v - 1))
        at = np.flatnonzero(open_)
        return repeated, at, self.rolling.of(at, at + self.length)


def _member(keys: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(listed, keys)
    at[at == len(listed)] = 0
    return listed[at] == keys


def _send(kind: int, chunk: int, keys: np.ndarray, n_buckets: int):
    """Rows ``bucket, chunk, kind, keys, several`` of the distinct keys of a chunk."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    distinct = keys[new]
    several = np.diff(np.append(np.flatnonzero(new), len(keys))) > 1
    bucket = ((distinct >> _U(32)) * _U(n_buckets) >> _U(32)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(bucket) else bucket
    for a, b in zip(edges, [*edges[1:], len(bucket)]):
        yield int(bucket[a]), chunk, kind, pack(distinct[a:b]), np.packbits(several[a:b]).tobytes()


_SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int8()), ("keys", pa.binary()), ("several", pa.binary())])
_SENT_DDL = "bucket int, chunk bigint, kind tinyint, keys binary, several binary"
_TIED = pa.schema([("chunk", pa.int64()), ("kind", pa.int8()), ("keys", pa.binary())])
_TIED_DDL = "chunk bigint, kind tinyint, keys binary"


def _batch(rows, schema: pa.Schema) -> pa.Table:
    rows = list(rows)
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)] if rows else [pa.array([], t) for t in schema.types], schema=schema)


def _sort_bucket(table: pa.Table) -> pa.Table:
    """Sort the keys of one bucket; each chunk gets back its keys that tie."""
    out = []
    chunks = np.asarray(table.column("chunk"))
    kinds = np.asarray(table.column("kind"))
    blobs, marks = table.column("keys"), table.column("several")
    for kind in np.unique(kinds):
        rows = np.flatnonzero(kinds == kind)
        parts = [unpack(blobs[int(r)].as_py()) for r in rows]
        several = np.concatenate([np.unpackbits(np.frombuffer(marks[int(r)].as_py(), np.uint8), count=len(p)) for r, p in zip(rows, parts)]).astype(bool)
        owner = np.repeat(chunks[rows], [len(p) for p in parts])
        keys = np.concatenate(parts)
        order = np.lexsort((owner, keys))
        keys, owner, several = keys[order], owner[order], several[order]
        same = keys[1:] == keys[:-1]
        tied = several.copy()
        tied[1:] |= same
        tied[:-1] |= same
        head = tied.copy()
        head[1:] &= ~same
        sorts = ((PROXY, head), (LONG, tied & ~head)) if kind == LONG else ((int(kind), tied),)
        for name, mask in sorts:
            picked, whose = keys[mask], owner[mask]
            by = np.argsort(whose, kind="stable")
            picked, whose = picked[by], whose[by]
            edges = np.flatnonzero(np.diff(whose, prepend=whose[0] - 1)) if len(whose) else []
            for a, b in zip(edges, [*edges[1:], len(whose)]):
                out.append((int(whose[a]), name, pack(picked[a:b])))
    return _batch(out, _TIED)


def _ranks(tied: pa.Table) -> dict[int, np.ndarray]:
    """The tied keys sent back to a chunk, sorted, by kind."""
    kinds, blobs = np.asarray(tied.column("kind")), tied.column("keys")
    return {
        k: np.sort(np.concatenate([unpack(blobs[int(r)].as_py()) for r in np.flatnonzero(kinds == k)] or [np.zeros(0, _U)]))
        for k in (SHORT, LONG, PROXY, SUFFIX)
    }


def _chunk_texts(id_type: pa.DataType, chunk_bytes: int):
    def cut(batches):
        seq = TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in blocks(batch.column(1), chunk_bytes):
                rows = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(block), seq)), pa.array(block.lengths), rows.column(0), rows.column(1)], ["chunk", "size", "doc_id", "text"]
                )
                seq += 1

    return cut


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False,
    chunk_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, and with
    ``with_text`` also ``spans`` (start and end bytes removed) and ``kept`` (the bytes that stay)."""
    if length < 29:
        raise ValueError("length must be at least 29 bytes")
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)[id_col]
    columns = f"chunk bigint, size bigint, doc_id {id_type}, text string"
    chunked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_chunk_texts(id_type, chunk_bytes), columns)
    name = f"suffix_chunks_{uuid4().hex}"
    n_files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = chunked.write.bucketBy(n_files, "chunk").option("compression", "zstd").option("path", scratch_path(spark, "chunks"))
    writer.saveAsTable(name)
    texts = spark.table(name)
    total = texts.agg(F.sum("size")).first()[0] or 0
    v, cover = difference_cover(length - 16)
    sample_buckets = 1 + int(total * len(cover) / v * 14) // bucket_bytes

    def send_ranks(batches):
        for batch in batches:
            rows = []
            chunk_of = np.asarray(batch.column(0))
            edges = np.flatnonzero(np.diff(chunk_of, prepend=-1)) if len(chunk_of) else []
            for a, b in zip(edges, [*edges[1:], len(chunk_of)]):
                for block in blocks(batch.column(1).slice(a, b - a), chunk_bytes):
                    own = _Chunk(block, length)
                    rows.extend(_send(SHORT, int(chunk_of[a]), own.short(), sample_buckets))
                    rows.extend(_send(LONG, int(chunk_of[a]), own.long(), sample_buckets))
            yield from _batch(rows, _SENT).to_batches()

    sent = texts.select("chunk", "text").mapInArrow(send_ranks, _SENT_DDL)
    ranks = stage(sent.groupBy("bucket").applyInArrow(_sort_bucket, _TIED_DDL), "ranks")
    # what is left to sort is at most the suffixes of repeated strings
    suffix_buckets = 1 + int(total * 6) // bucket_bytes

    def send_suffixes(text: pa.Table, tied: pa.Table) -> pa.Table:
        rows, known = [], _ranks(tied)
        if not len(known[SHORT]):
            return _batch([], _SENT)
        chunk = text.column("chunk")[0].as_py() if text.num_rows else 0
        for block in blocks(text.column("text"), chunk_bytes):
            _, _, keys = _Chunk(block, length).resolve(known)
            rows.extend(_send(SUFFIX, chunk, keys, suffix_buckets))
        return _batch(rows, _SENT)

    def cut(text: pa.Table, tied: pa.Table) -> pa.Table:
        known, out = _ranks(tied), []
        for block in blocks(text.column("text"), chunk_bytes):
            repeated = np.zeros(len(block.data), bool)
            if len(known[SHORT]):
                own = _Chunk(block, length)
                repeated, at, keys = own.resolve(known)
                repeated[at[_member(keys, known[SUFFIX])]] = True
            at = np.flatnonzero(repeated)
            n = len(block.data)
            steps = np.bincount(at, minlength=n + 1) - np.bincount(at + length, minlength=n + 1)
            gone = np.cumsum(steps[:n]) > 0
            for k in range(len(block)):
                a, b = block.bounds[k], block.bounds[k + 1]
                edges = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0))
                kept = block.data[a:b][~gone[a:b]].tobytes()
                row = [int(b - a), int(b - a - len(kept)), len(edges) // 2, hashlib.sha256(kept).hexdigest()]
                out.append(row + [[{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)], kept] if with_text else row)
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["spans", "kept"] * with_text
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        columns = [pa.array([r[c] for r in out], t) for c, t in zip(range(len(names)), types)]
        return pa.table([text.column("doc_id"), *columns], ["doc_id", *names])

    by_chunk = texts.groupBy("chunk")
    suffixes = by_chunk.cogroup(ranks.groupBy("chunk")).applyInArrow(send_suffixes, _SENT_DDL)
    tied = stage(suffixes.groupBy("bucket").applyInArrow(_sort_bucket, _TIED_DDL), "suffixes")
    schema = f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    schema += ", spans array<struct<start: bigint, end: bigint>>, kept binary" if with_text else ""
    return by_chunk.cogroup(ranks.unionByName(tied).groupBy("chunk")).applyInArrow(cut, schema)
