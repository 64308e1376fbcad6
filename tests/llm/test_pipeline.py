"""Each stage against a plain version of its rule, on its own input."""

import re
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from plain import corpus
from skytide.llm.mixing import targets
from test_decontaminate import brute as leaks
from test_jaccard_join import brute as components
from test_langid import documents
from test_shards import brute as shards

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, lang, f"s{i % 4}", len(t)) for i, t, lang in documents(120)]
    texts = [t for _, t in corpus(6, 30)]
    rows += [(1000 + k, t, "en", None if k % 7 == 0 else f"s{k % 3}", None) for k, t in enumerate(texts)]
    item = " ".join(texts[2].split()[:12]) if len(texts[2].split()) >= 12 else texts[1]
    rows += [(2000, f"before {item} after", "en", "s1", 1), (None, "only once", "en", "s1", 1), (None, "only once", "en", "s2", 1), (5, rows[5][1], "fr", "s1", 2)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "zz yy xx")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, [(1, item), (2, "zz yy xx")]


def test_stages_one_after_the_other(spark, tables):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    outputs = []
    for name, function in pipeline.STAGES:
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out = function(spark, docs, folder)
        outputs.append((name, [tuple(r) for r in docs.collect()], [tuple(r) for r in out.collect()], out.columns, docs.columns))
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert [o[0] for o in outputs] == [n for n, _ in pipeline.STAGES]
    for _, _, _, columns, before in outputs[:-1]:
        assert columns == before
    _, before, after, _, _ = outputs[0]  # language
    assert set(map(str, after)) <= set(map(str, before))
    assert all(re.search(r"[^\W\d_]", t[1] or "") for t in after)
    assert len(after) >= 0.9 * sum(bool(re.search(r"[^\W\d_]", t[1] or "")) for t in before)
    _, before, after, _, _ = outputs[1]  # near copies
    wanted = {(r[0], r[2]) for r in components([((t[0] is None, t[0] or 0), t[1]) for t in before])}
    groups = len({c for _, c in wanted})
    assert len(after) == groups and Counter(map(str, after)).most_common(1)[0][1] == 1
    assert {(t[0] is None, t[0] or 0) for t in after} == {c for _, c in wanted}
    _, before, after, _, _ = outputs[2]  # benchmark
    dirty = {r[0] for r in leaks([(t[0], t[1]) for t in before], items) if r[5]}
    assert 2000 in dirty or not any(t[0] == 2000 for t in before)
    assert sorted(map(str, after)) == sorted(str(t) for t in before if t[0] not in dirty)
    _, before, after, _, _ = outputs[3]  # mixing
    sizes, taken = Counter(), Counter()
    for t in before:
        sizes[t[3]] += len(t[1].split())
    for t in after:
        taken[t[3]] += len(t[1].split())
    goal = targets(dict(sizes))
    longest = max(len(t[1].split()) for t in before)
    assert all(abs(taken[s] - goal[s]) <= longest for s in sizes)
    assert max(Counter(map(str, after)).values()) <= 3 and set(map(str, after)) <= set(map(str, before))
    _, before, after, columns, _ = outputs[4]  # shards
    mine = sorted((tuple(r[columns.index(c)] for c in ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")) for r in after), key=str)
    assert mine == shards([(t[0], t[1]) for t in before], 16)


def test_run_and_clashing_columns(spark, tables):
    folder, _, _ = tables
    assert pipeline.run(spark, folder).count() > 0
    frame = spark.createDataFrame(
        [(1, "the ing ou", "en", "a", 9, 1, "x", 0.5, "r"), (2, "the ing ou", "en", "a", 9, 1, "x", 0.5, "r"), (3, None, None, None, None, None, None, None, None)],
        SCHEMA + ", k1 int, lang_pred string, score double, row string",
    )
    for _, function in pipeline.STAGES[:-1]:
        assert function(spark, frame, folder).columns == frame.columns
        assert function(spark, frame.limit(0), folder).collect() == []
    assert pipeline.STAGES[-1][1](spark, frame.limit(0), folder).collect() == []
