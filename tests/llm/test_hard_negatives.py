import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import skytide.llm.hard_negatives as module
from skytide.llm.hard_negatives import falling_cells, hard_negatives

SCHEMA = "vec_id bigint, label int, embedding array<float>"
ANCHOR = "vec_id % 10 = 0"


def brute(rows, n_positives=5, n_negatives=10):
    """Every anchor with every row, in whole numbers."""
    def fine(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    rows = [(i, y, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, y, v in rows if y is not None and fine(v)]
    last = 1 << 70
    out = []
    for a, (i, y, v) in enumerate(rows):
        if i is None or i % 10:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), last if j is None else j, b, z) for b, (j, z, w) in enumerate(rows) if b != a and len(w) == len(v)]
        scored.sort()
        for p, pid, _, _ in [s for s in scored if s[3] == y][:n_positives]:
            fits = [s for s in scored if s[3] != y and 30 * -p <= 100 * -s[0] <= 90 * -p][:n_negatives]
            out += [(i, pid, k + 1, s[1], -p, -s[0]) for k, s in enumerate(fits)]
    return [tuple(None if x == last else x for x in r) for r in out]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, width=9, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    rows = []
    for i in range(n):
        v = centres[i % 6] + rng.normal(size=width) * rng.choice([0.05, 0.4, 1.5])
        rows.append((i, int(rng.integers(4)), (v / np.linalg.norm(v)).astype(np.float32).tolist()))
    return rows


@pytest.mark.parametrize("cell_rows, block_rows, shelf", [(1024, 2048, 16), (4, 3, 2)])
def test_matches_brute_force(spark, monkeypatch, cell_rows, block_rows, shelf):
    for name, value in dict(CELL_ROWS=cell_rows, BLOCK_ROWS=block_rows, SHELF=shelf, FIRST_CELLS=2).items():
        monkeypatch.setattr(module, name, value)
    rows = vectors(230)
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), ANCHOR)
    assert found(got) == sorted(brute(rows), key=str)


def test_equal_vectors_and_ties(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_ROWS", 16)
    rows = [(i, i % 3, [0.5, 0.5, 0.1]) for i in range(60)] + [(60 + i, i % 3, [0.3, 0.2, 0.0]) for i in range(60)]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), ANCHOR)
    assert found(got) == sorted(brute(rows), key=str) != []


def test_rows_that_take_no_part(spark):
    rows = vectors(60, width=4)
    rows += [(100, None, [1.0] * 4), (110, 1, None), (120, 1, [1.0, None, 0.0, 0.0]), (130, 2, [float("nan")] * 4), (140, 2, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, 1, [0.4, 0.3, 0.2, 0.1]), (None, 3, [0.4, 0.3, 0.2, 0.1]), (20, 0, rows[20][2]), (150, 0, []), (160, 1, [0.0] * 4), (170, 0, [0.5, 0.5])]
    rows += [(171, 0, [0.5, 0.25]), (172, 1, [0.25, 0.25])]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA).withColumn("uid", F.lit(1)).withColumn("score", F.lit("x")), ANCHOR)
    assert found(got) == sorted(brute(rows), key=str)


def test_no_rows_and_large_components(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA), ANCHOR).collect() == []
    assert hard_negatives(spark.createDataFrame([(1, 1, [1.0])], SCHEMA), ANCHOR).collect() == []
    with pytest.raises(ValueError, match="too large"):
        hard_negatives(spark.createDataFrame([(0, 1, [1e30])], SCHEMA), ANCHOR)
    rows = [(i, i % 2, [1e5 + 7 * i, -3e5 * (i % 3)]) for i in range(21)]  # beyond what doubles hold exactly
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), ANCHOR, scale=256)
    assert found(got) == sorted(brute(rows), key=str) != []


def test_heap_visits_by_falling_sum():
    rng = random.Random(2)
    one, two = np.array([rng.random() for _ in range(7)]), np.array([rng.random() for _ in range(5)])
    visits = list(falling_cells(one, two))
    assert len({(i, j) for _, i, j in visits}) == 35
    assert [b for b, _, _ in visits] == sorted((b for b, _, _ in visits), reverse=True)
