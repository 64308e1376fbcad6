import random
import re

import pytest

from plain import corpus, prose, twins
from skytide.llm.components import components
from skytide.llm.jaccard_join import jaccard_components

SCHEMA = "doc_id bigint, text string"


def shingles(text, n):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return set()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)}


def brute(rows, n=5, percent=75):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    small = {}
    for k, (i, _) in enumerate(rows):
        small[find(k)] = min(small.get(find(k), i), i)
    return sorted((i, len(s), small[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def families(seed, members=60):
    """Near copies of hidden and present origins, at similarities around the threshold."""
    rng = random.Random(seed)
    rows = []
    for _ in range(4):
        origin = prose(rng, rng.randint(30, 150)).split()
        rows.append(" ".join(origin)) if rng.random() < 0.5 else None
        for _ in range(members):
            words = list(origin)
            for _ in range(rng.randint(1, max(1, len(words) // 35))):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            words = words[: rng.randint(len(words) - 8, len(words))]
            rows.append(" ".join(words) if rng.random() < 0.9 else " ".join(words).upper())
    license_ = prose(rng, 60)
    rows += [f"{license_} {prose(rng, rng.randint(5, 40))}" for _ in range(60)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = families(seed) + [(1000 + i, t) for i, t in corpus(seed)]
    got = jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(3)).drop("k1", "root")
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_other_threshold_and_width(spark):
    rows = families(5, 20)
    got = jaccard_components(spark.createDataFrame(rows, SCHEMA), ngram=3, percent=60).drop("k1", "root")
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 60)


def test_edges(spark):
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(3, None), (4, ""), (5, " \t"), (6, "one two"), (7, "ONE  two"), (8, "two one"), (None, "one two")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (1, 8), None: (1, 6)}
    frame = spark.createDataFrame([(1, "a b", 1, "x"), (2, "a b", 2, "y")], "doc_id bigint, text string, key int, bitmap string")
    assert {r.component_id for r in jaccard_components(frame).collect()} == {1}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(0, 300)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    ids = list(range(2000, 2100))
    rng.shuffle(ids)
    tangled = list(zip(ids, ids[1:]))
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star + tangled + [(5, 5)], "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(301)}, **{k: 1000 for k in range(1000, 1200)}, **{k: 2000 for k in range(2000, 2100)}}
    assert components(spark.createDataFrame([(5, 5)], "a bigint, b bigint")).collect() == []


def test_words_that_polynomial_hashes_confuse(spark):
    one, other = twins()
    rows = [(1, one), (2, other), (3, f"{one} x y z"), (4, f"{other} x y z"), (5, one.upper())]
    got = jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
