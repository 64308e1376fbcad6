import math
import random

import pytest

from plain import corpus, prose
from skytide.llm.mixing import mix, solve, targets

SCHEMA = "doc_id bigint, text string, source string"


def documents(n=600, seed=2):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(1, 60)), rng.choice(["a"] * 6 + ["b", "c", "é", None])) for i in range(n)]
    return rows + [(n + k, t, "b") for k, (_, t) in enumerate(corpus(seed, 3)[:12])] + [(None, None, "empty"), (5, "", "a")]


def test_targets_share_and_stop_at_the_cap():
    assert targets({"a": 100, "b": 100, None: 100}) == {"a": 187.5, "b": 75.0, None: 37.5}
    # by weight 1000 words: a 625, above 300; the rest is shared by 2 and 1
    got = targets({"a": 100, "b": 500, None: 400})
    assert got["a"] == 300 and got["b"] == pytest.approx(1400 / 3) and got[None] == pytest.approx(700 / 3)
    assert targets({"a": 0, "b": 10}) == {"a": 0.0, "b": 10.0}


def test_mix_comes_near_every_target(spark):
    rows = documents()
    frame = spark.createDataFrame(rows, SCHEMA)
    got = mix(frame.repartition(4)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    goal = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 120, s
    again = mix(frame.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


@pytest.mark.parametrize("equal, others", [(900, 40), (5, 300)])
def test_repeated_rows_are_taken_one_by_one(spark, equal, others):
    rows = [(1, "same three words", "a")] * equal + [(k, "b words", "b") for k in range(others)] + [(None, "x y z", "c")] * 50
    goal = targets({"a": 3 * equal, "b": 2 * others, "c": 150})
    frame = spark.createDataFrame(rows, SCHEMA)
    got = mix(frame.repartition(3)).collect()
    taken = dict.fromkeys(goal, 0)
    for r in got:
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size
    assert len(got) == len(rows) and all(abs(taken[s] - goal[s]) <= 3 for s in goal), (taken, goal)
    assert sorted(map(str, got)) == sorted(map(str, mix(frame.repartition(5)).collect()))


def test_base_rates_and_targets_out_of_reach(spark):
    frame = spark.createDataFrame([("a", 10, 0.5), ("a", 30, 2.0), ("b", 20, 1.0)], "source string, size bigint, base double")
    multiplier = solve(frame, {"a": 50.0, "b": 20.0})
    assert sum(min(3, base * math.exp(multiplier["a"])) * n for n, base in ((10, 0.5), (30, 2.0))) == pytest.approx(50, rel=1e-5)
    small = solve(frame, {"a": 0.013, "b": 60.0})  # a very small rate, and one at the cap
    assert sum(base * math.exp(small["a"]) * n for n, base in ((10, 0.5), (30, 2.0))) == pytest.approx(0.013, rel=1e-5)
    assert min(3, math.exp(small["b"])) == pytest.approx(3, rel=1e-5)
    with pytest.raises(ArithmeticError, match="not met"):
        solve(frame, {"a": 50.0, "b": 20.0}, steps=1)


def test_edges(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []
    only = mix(spark.createDataFrame([(1, None, None), (2, None, None)], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2
    rows = [(1, "same text here", "a", 1.0, "m")] * 30 + [(2, "x y", "b", 2.0, "m")]
    got = mix(spark.createDataFrame(rows, SCHEMA + ", base double, multiplier string")).collect()
    assert len(got) == 31 and {r.source_size for r in got} == {90, 2}
