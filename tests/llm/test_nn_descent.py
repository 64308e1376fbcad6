import numpy as np

from skytide.llm import nn_descent
from skytide.llm.nn_descent import near_components

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(seed, n=300, size=24):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(size) for _ in range(n)]
    for family, spread in ((150, 0.05), (30, 0.09), (20, 0.16)):
        centre = rng.standard_normal(size)
        rows += [centre * rng.uniform(0.5, 2) + spread * rng.standard_normal(size) for _ in range(family)]
    for _ in range(40):
        k = rng.integers(n)
        rows.append(rows[k] + 0.08 * rng.standard_normal(size))
    rows += [rows[3]] * 12
    labels = [int(k) for k in rng.integers(0, 2, len(rows))]
    return [(i, [float(np.float32(x)) for x in v], lab) for i, (v, lab) in enumerate(zip(rows, labels))]


def links(rows, threshold=0.98):
    found = set()
    for lab in {r[2] for r in rows if r[2] is not None}:
        own = [r for r in rows if r[2] == lab]
        m = np.array([r[1] for r in own])
        m /= np.linalg.norm(m, axis=1)[:, None]
        for i, j in zip(*np.nonzero(m @ m.T >= threshold)):
            if i < j:
                found.add((own[i][0], own[j][0]))
    return found


def test_recall_and_no_false_link(spark):
    rows = vectors(1)
    true = links(rows)
    degree = dict.fromkeys((r[0] for r in rows), 0)
    for a, b in true:
        degree[a] += 1
        degree[b] += 1
    got = {r.vec_id: r for r in near_components(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].n_links <= degree[i] for i in degree)
    assert sum(r.n_links for r in got.values()) >= 0.97 * 2 * len(true)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    parent = {i: i for i in degree}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in true:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert sum(got[i].component_id == find(i) for i in degree) >= 0.99 * len(degree)


def test_unusable_vectors_link_with_nothing(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 0), (2, [2.0, 4.0, 6.0], 0), (3, v, 1), (4, v, None), (5, v, None), (6, None, 0), (7, None, 0), (8, [0.0] * 3, 0), (9, [-0.0] * 3, 0),
        (10, [1.0, None, 3.0], 0), (11, [float("nan")] * 3, 0), (12, [float("inf"), 1.0, 1.0], 0), (13, [], 0), (14, [], 0), (15, v + [0.0], 0),
        (None, v, 0), (16, [0.0, 1.0, 0.0], 2), (17, [-0.0, 1.0, -0.0], 2),
    ]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[None] == (2, 1, False)
    assert got[16] == (1, 16, True) and got[17] == (1, 16, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15):
        assert got[i] == (0, i, True)


def test_edges(spark):
    assert near_components(spark.createDataFrame([], SCHEMA)).collect() == []
    frame = spark.createDataFrame([(1, [1.0], 1, 5, 6.0), (2, [2.0], 1, 5, 6.0)], SCHEMA + ", node int, cos double")
    assert sorted(r.n_links for r in near_components(frame).collect()) == [1, 1]


def test_family_larger_than_the_rounds_can_join(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "PART", 6)
    monkeypatch.setattr(nn_descent, "BLOCK", 64)
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(24)
    rows = [(i, [float(np.float32(x)) for x in centre + 0.03 * rng.standard_normal(24)], 0) for i in range(300)]
    rows += [(1000 + i, [float(np.float32(x)) for x in rng.standard_normal(24)], 0) for i in range(100)] + [(2000, rows[0][1], 0)]
    want = dict.fromkeys((r[0] for r in rows), 0)
    for pair in links(rows):
        for k in pair:
            want[k] += 1
    assert want[5] >= 295
    got = near_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: r.n_links for r in got} == want
    assert {r.component_id for r in got if want[r.vec_id]} == {0}


def test_all_pairs_where_the_search_stands_still(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "RESTARTS", 0)
    monkeypatch.setattr(nn_descent, "BLOCK", 50)
    rows = vectors(2)
    want = dict.fromkeys((r[0] for r in rows), 0)
    for pair in links(rows):
        for k in pair:
            want[k] += 1
    got = near_components(spark.createDataFrame(rows, SCHEMA), recall=2.0).collect()  # never reached
    assert {r.vec_id: r.n_links for r in got} == want
    assert all((r.component_id == r.vec_id) == r.kept for r in got)
