import zlib

from plain import corpus
from skytide.llm.shards import shard_by_bytes

SCHEMA = "doc_id bigint, text string"


def brute(rows, n_shards):
    """Rows of equal id, checksum and size are interchangeable."""
    sized = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    sized.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    total, at, out, slots = sum(r[1] for r in sized), 0, [], {}
    for i, size, crc in sized:
        shard = at * n_shards // total
        out.append((i, size, crc, "bytes", shard, slots.setdefault(shard, 0), None))
        slots[shard] += 1
        at += size
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    rows = corpus(4, 120)
    got = shard_by_bytes(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 16)


def test_ties_nulls_and_few_rows(spark):
    rows = [(None, "same")] * 40 + [(7, "same")] * 3 + [(None, None)]
    got = shard_by_bytes(spark.createDataFrame(rows, SCHEMA).repartition(4), n_shards=5)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 5)
    got = shard_by_bytes(spark.createDataFrame([(1, "a"), (2, "b" * 500)], SCHEMA))
    assert sorted((r.shard, r.slot) for r in got.collect()) == [(0, 0), (0, 1)]
    assert shard_by_bytes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_carried_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a", 5, "x"), (2, "bb", 6, "y")], "doc_id bigint, text string, shard int, size string")
    got = shard_by_bytes(frame, 2, carry=("text",)).orderBy("doc_id").collect()
    assert [(r.text, r.shard, r.slot) for r in got] == [("a", 0, 0), ("bb", 0, 1)]
