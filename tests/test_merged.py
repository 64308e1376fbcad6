import random

import pytest
from pyspark.sql import functions as F

from skytide.operators import merged
from skytide.operators.merged import commits, compact_merged, drop_replaced, merge_alerts, read_merged
from skytide.sources.log_index import list_parquet

SCHEMA = "k long, part string, v string, o int"


def frame(spark, rows):
    return spark.createDataFrame([(k, None if k is None else f"p{k % 3}", v, n) for n, (k, v) in enumerate(rows)], SCHEMA)


def put(spark, path, rows, mode="overwrite", partitions=("part",)):
    return merge_alerts(frame(spark, rows), path, ["k"], mode, list(partitions), ["o"])


def seen(spark, path):
    rows = read_merged(spark, path).collect()
    assert len({r.k for r in rows}) == len(rows)
    return {r.k: r.v for r in rows}


@pytest.mark.parametrize("partitions", [(), ("part",)])
def test_an_overwrite_writes_its_input_and_no_more(spark, path, partitions):
    rng, model = random.Random(1), {}
    for turn in range(4):
        rows = [(rng.randrange(300), f"{turn}.{n}") for n in range(400 if turn == 0 else 30)]
        before, held = set(list_parquet(path)), len({k for k, _ in rows} & set(model))
        done = put(spark, path, rows, partitions=partitions)
        model.update(rows)
        assert before <= set(list_parquet(path))  # no file is written anew
        assert (done.rows, done.deleted) == (len(dict(rows)), held)
        assert seen(spark, path) == model
    plan = read_merged(spark, path).filter("k = 5").select("v")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,5)" in plan and "o#" not in plan.split("ReadSchema")[1].split(">")[0]


def test_modes(spark, path):
    put(spark, path, [(1, "a"), (2, "a"), (None, "a"), (2, "b")])
    assert seen(spark, path) == {1: "a", 2: "b", None: "a"}
    with pytest.raises(IOError, match="alert 2 already exists"):
        put(spark, path, [(2, "c"), (7, "c")], "error")
    with pytest.raises(IOError, match="already exists"):
        put(spark, path, [(8, "c"), (8, "d")], "error")
    put(spark, path, [(7, "c")], "error")
    assert put(spark, path, [(1, "d")], "ignore") is None
    put(spark, path, [(1, "d"), (9, "d"), (None, "d")], "ignore")
    put(spark, path, [(None, "e")])
    assert seen(spark, path) == {1: "a", 2: "b", None: "e", 7: "c", 9: "d"}
    with pytest.raises(ValueError):
        put(spark, path, [], "append")


def test_a_write_that_died_before_its_mark_does_not_count(spark, path, monkeypatch):
    put(spark, path, [(1, "a"), (2, "a")])
    real = merged._commit
    monkeypatch.setattr(merged, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        put(spark, path, [(1, "b"), (3, "b")])
    monkeypatch.setattr(merged, "_commit", real)
    assert seen(spark, path) == {1: "a", 2: "a"}
    put(spark, path, [(1, "c"), (3, "c")])
    assert seen(spark, path) == {1: "c", 2: "a", 3: "c"}


def test_compaction_keeps_every_row_and_large_commits(spark, path):
    rng, model = random.Random(2), {}
    put(spark, path, rows := [(k, "base") for k in range(500)])
    model.update(rows)
    [base] = commits(path)
    for turn in range(3):
        put(spark, path, rows := [(rng.randrange(600), f"{turn}.{n}") for n in range(40)])
        model.update(rows)
    done = compact_merged(spark, path, ["part"], small_rows=100)
    assert [c.name for c in commits(path)] == [base.name, done.name] and base.name not in done.replaces
    assert seen(spark, path) == model
    put(spark, path, rows := [(k, "late") for k in range(0, 600, 7)])
    model.update(rows)
    assert drop_replaced(spark, path) >= 3 and seen(spark, path) == model
    put(spark, path, rows := [(k, "most") for k in range(0, 400)])
    model.update(rows)
    compact_merged(spark, path, ["part"], replaced=0.5, small_rows=100)
    assert base.name not in {c.name for c in commits(path)} and seen(spark, path) == model
    assert drop_replaced(spark, path) and seen(spark, path) == model
    assert compact_merged(spark, path, small_rows=0) is None


def test_columns_of_both_sides_and_moving_keys(spark, path):
    with pytest.raises(IOError, match="nothing is stored"):
        read_merged(spark, path)
    put(spark, path, [(1, "a"), (2, "a")])
    more = spark.createDataFrame([(1, "p9", 5)], "k long, part string, extra int")
    merge_alerts(more, path, ["k"], "overwrite", ["part"])
    got = {r.k: (r.part, r.v, r.extra) for r in read_merged(spark, path).collect()}
    assert got == {1: ("p9", None, 5), 2: ("p2", "a", None)}
    assert read_merged(spark, path).filter(F.col("part") == "p1").count() == 0
