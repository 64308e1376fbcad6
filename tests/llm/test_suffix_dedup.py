import hashlib
from collections import Counter

import numpy as np
import pytest

from plain import corpus, twins
from skytide.llm.suffix_dedup import difference_cover, repeated_spans

SCHEMA = "doc_id bigint, text string"


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 2, int)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p + 1 : p + length + 1] = 1
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((i, len(t), len(t) - len(kept), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [13, 73, 200, 384])
def test_cover_reaches_every_difference(limit):
    v, cover = difference_cover(limit)
    assert v <= limit
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("length", [29, 60, 130, 400])
def test_matches_brute_force(spark, length):
    rows = corpus()
    got = repeated_spans(spark.createDataFrame(rows, SCHEMA).repartition(3), length=length, chunk_bytes=20_000, bucket_bytes=50_000)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, length)


def test_query_rule_at_production_length(spark):
    rows = [(i, t * 3 if t else t) for i, t in corpus(2, 25)]
    got = repeated_spans(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 400)


def test_spans_and_kept_bytes(spark):
    row = repeated_spans(spark.createDataFrame([(1, "ab" * 300 + "tail"), (2, None)], SCHEMA), with_text=True).where("doc_id = 1").first()
    assert [tuple(s) for s in row.spans] == [(0, 600)] and bytes(row.kept) == b"tail"


def test_no_rows_null_ids_extra_columns(spark):
    assert repeated_spans(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "q" * 450, 1, "k"), (None, "q" * 450, 2, "k")]
    got = repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string, chunk int, keys string")).collect()
    assert [r.n_removed for r in got] == [450, 450]


def test_strings_that_polynomial_hashes_confuse(spark):
    one, other = twins(9)  # 512 bytes each; the 400-byte strings in them are told apart
    rows = [(1, one), (2, other), (3, one[:300] + other[:300]), (4, other[56:456])]
    got = repeated_spans(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 400)
