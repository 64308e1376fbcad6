import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plain import corpus
from skytide.llm.periodic_runs import collapsed_runs, periodic_tail, runs_by_text, runs_of_segment, surviving_segments, word_classes

SCHEMA = "doc_id bigint, text string"


def brute_runs(words):
    """Every lag, every place."""
    runs, seen = [], set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                runs.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def brute(rows, planted=False):
    out = []
    for i, text in rows:
        words = (text or "").encode().split()
        n = len(words)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if planted and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(words)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = (None,) * 4
        if runs:
            s, m, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            best = (s, m, q, 1000 * m // q)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(runs), *best, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sequences():
    rng = random.Random(3)
    for k in range(900):
        letters = rng.choice(["ab", "abc", "abcdef"])
        out = []
        while len(out) < rng.choice([5, 20, 60, 150]):
            unit = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
            out += unit * rng.randint(1, 9)
            out += [rng.choice(letters + "xyz")] * rng.randint(0, 2)
        yield out
    yield list("a" * 400)
    yield list("ab" * 200 + "a" * 50 + "ba" * 33)


def test_segments_and_lags_match_brute_force():
    for words in sequences():
        classes, bounds = word_classes(pa.array([" ".join(words)]))
        assert runs_by_text(classes, bounds).get(0, []) == brute_runs(words), words


def test_lag_scan_alone_matches_brute_force():
    for words in sequences():
        classes = np.unique(words, return_inverse=True)[1]
        assert sorted(runs_of_segment(classes), key=lambda r: (r[0], r[2])) == brute_runs(words), words


def test_words_too_rare_split_until_nothing_splits():
    # x splits; then b, which had occurred five times in all, is too rare on either side
    words = "a b a b a x b a b a b a a c c c c c c".split()
    classes, bounds = word_classes(pa.array([" ".join(words)]))
    start, end = surviving_segments(classes, bounds)
    assert list(zip(start, end)) == [(13, 19)]


def test_words_are_told_apart_by_their_bytes():
    one = "a"
    other = "b"
    for _ in range(10):  # strings that collide in polynomial hashes modulo 2^64
        one, other = one + other, other + one
    classes, _ = word_classes(pa.array([f" {one} {other}\t\n {one}", None, "", "\x0b"]))
    assert classes[0] == classes[2] != classes[1]


@pytest.mark.parametrize("block_bytes", [1, 2000, 4 << 20])
def test_matches_brute_force(spark, block_bytes):
    rows = corpus() + [(100 + k, " ".join(w)) for k, w in zip(range(60), sequences())]
    rows += [(300, "la  la\tla la\x0bla la la"), (301, "x y " * 3), (None, "z " * 9), (None, "z " * 9)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(collapsed_runs(docs, block_bytes=block_bytes)) == brute(rows)
    planted = collapsed_runs(docs, text=periodic_tail(F.col("doc_id"), F.col("text")), block_bytes=block_bytes)
    assert found(planted) == brute(rows, planted=True)


def test_runs_and_collapsed_text(spark):
    rows = [(1, "so very very very very very very good good ha ha ha"), (2, None)]
    one, two = collapsed_runs(spark.createDataFrame(rows, SCHEMA), with_text=True).orderBy("doc_id").collect()
    assert [tuple(r) for r in one.runs] == [(1, 6, 1)] and one.collapsed == "so very good good ha ha ha"
    assert two.runs == [] and two.collapsed == "" and two.start is None


def test_very_long_texts(spark):
    rng = random.Random(1)
    rows = [(1, "a " * 300_000), (2, " ".join(rng.choice("abcd") for _ in range(60_000))), (3, "p q r " * 90_000)]
    got = {r.doc_id: r for r in collapsed_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1].n_runs, got[1].length, got[1].period) == (1, 300_000, 1)
    assert (got[3].n_runs, got[3].length, got[3].period) == (1, 270_000, 3)


def test_no_rows_extra_columns(spark):
    assert collapsed_runs(spark.createDataFrame([], SCHEMA)).collect() == []
    got = collapsed_runs(spark.createDataFrame([("k", "e " * 7, 4)], "doc_id string, text string, start int")).collect()
    assert (got[0].doc_id, got[0].start, got[0].length) == ("k", 0, 7)
