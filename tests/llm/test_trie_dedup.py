import hashlib
import random
from collections import defaultdict

import pytest

from plain import corpus
from skytide.llm.trie_dedup import Trie, text_owners

SCHEMA = "doc_id bigint, text string"


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        bare = "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
        groups[bare].append((-len(t or ""), i is None, i))
    out = []
    for bare, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        sha = hashlib.sha256(bare.encode()).hexdigest()
        out += [(i, members[0][2], len(members), k == 0, sha) for k, (_, _, i) in enumerate(members)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def spaced(rows):
    rng = random.Random(5)
    more = [(1000 + i, "\t".join(t.split(" ")) + rng.choice(["", " ", "\n\n", "\x0b", "\xa0"])) for i, t in rows if t and rng.random() < 0.5]
    return rows + more + [(2000 + i, t) for i, t in rows[:9]]


@pytest.mark.parametrize("held, fan", [(32 << 20, 256), (3000, 256), (1, 2)])
def test_matches_brute_force(spark, held, fan):
    rows = spaced(corpus())
    got = text_owners(spark.createDataFrame(rows, SCHEMA).repartition(7), held_bytes=held, fan=fan)
    assert found(got) == brute(rows)


def test_one_text_in_most_rows(spark):
    rows = [(i, "same text" if i % 3 else f"own {i}") for i in range(600)]
    got = text_owners(spark.createDataFrame(rows, SCHEMA).repartition(12), held_bytes=200, fan=4)
    assert found(got) == brute(rows)


def test_prefixes_and_forks():
    trie, words = Trie(), [b"", b"a", b"ab", b"abc", b"abd", b"b", b"abcdef", b"abc"]
    for w in words:
        trie.node(w).terminal = w
    assert sorted(trie.terminals()) == sorted(set(words))
    assert sorted(trie.terminals(ord("a"))) == [b"a", b"ab", b"abc", b"abcdef", b"abd"]


def test_ties_nulls_and_repeated_rows(spark):
    rows = [(5, "a b"), (3, "ab "), (3, "ab "), (None, "a b"), (None, None), (None, ""), (9, " \t"), (4, "ab")]
    got = found(text_owners(spark.createDataFrame(rows, SCHEMA).repartition(3), held_bytes=1))
    assert got == brute(rows)
    assert sum(r[3] for r in got) == 2 and {r[1] for r in got if r[2] == 5} == {3}


def test_no_rows_text_ids_extra_columns(spark):
    assert text_owners(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [("b", "x y", 1, "n"), ("a", "xy ", 2, "n"), ("c", "z" * 3_000_000, 3, "n")]
    got = text_owners(spark.createDataFrame(rows, "doc_id string, text string, n int, node string"))
    assert {(r.doc_id, r.keep_id, r.kept) for r in got.collect()} == {("b", "a", False), ("a", "a", True), ("c", "c", True)}
