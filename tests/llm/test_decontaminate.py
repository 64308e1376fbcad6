import hashlib
import random
import re

from plain import corpus, prose, twins
from skytide.llm import decontaminate as dc

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, width=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= ids
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def tables(seed):
    rng = random.Random(seed)
    items = [(k, prose(rng, rng.randint(11, 30))) for k in range(12)] + [(20, "Zebra quagga"), (21, "ocean"), (22, None), (23, " - "), (None, prose(rng, 12)), (24, "the the the the the the the the the the the")]
    docs = corpus(seed)
    for k in range(40):
        item = items[rng.randrange(12)][1].split()
        a = rng.randint(0, 5)
        part = " ".join(item[a : a + rng.randint(7, 14)])
        part = part.upper().replace(" ", "; ") if k % 3 == 0 else part
        docs.append((500 + k, f"{prose(rng, 30)} {part} {prose(rng, 10)} {part if k % 5 == 0 else ''}"))
    docs += [(600, "zebra-QUAGGA"), (601, "zebra"), (602, "the " * 60), (603, items[-2][1]), (None, items[0][1]), (604, items[0][1]), (604, items[0][1])]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = tables(3)
    got = dc.find_contamination(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS))
    assert sorted(map(tuple, got.drop("items", "k1").collect()), key=str) == brute(docs, items)


def test_word_lists_in_slices(spark):
    docs, items = tables(4)
    got = dc.find_contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), width=5, slice_terms=9)
    assert sorted(map(tuple, got.drop("items", "k1").collect()), key=str) == brute(docs, items, 5)


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma")], ITEMS)
    rows = [(1, "gamma x x alpha"), (2, "gamma x x x alpha beta"), (3, "alpha only")]
    texts = dc.keyed(spark.createDataFrame(rows, DOCS), "doc_id", "text")
    windows = dc.item_windows(items, "item_id", "text")
    chosen = windows.selectExpr("window", "posexplode(words) as (offset, term)").where("offset <> 1").selectExpr("window", "term", "offset", "int(offset / 2) as slot", "2 as need")
    index = dc.postings(texts, chosen.select("term"))
    near = lambda n: {r.doc_id for r in dc.proximity_matches(index, chosen, n).join(texts, ["k1", "k2"]).collect()}
    assert near(2) == set() and near(3) == {1} and near(4) == {1, 2}


def test_edges(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert dc.find_contamination(docs, items).collect() == []
    some = spark.createDataFrame([(1, "a b", 3, "y")], DOCS + ", k1 int, words string")
    row = dc.find_contamination(some, items).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)
    row = dc.find_contamination(some, spark.createDataFrame([(7, "B", "z")], ITEMS + ", items string")).first()
    assert (row.n_hit, row["items"], row.contaminated) == (1, ["7"], True)


def test_near_items_beside_exact_ones(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    changed = " ".join("other" if k % 9 == 4 else w for k, w in enumerate(item.split()))
    rows = [(1, f"so {changed} so"), (2, f"so {item}"), (3, "alpha " + "so " * 30 + "upsilon"), (4, None), (5, "the " * 9)]
    items = spark.createDataFrame([(7, item), (8, "the the the the"), (9, "nowhere else"), (10, "upsilon tau")], ITEMS)
    got = {r.doc_id: r for r in dc.find_contamination(spark.createDataFrame(rows, DOCS), items, within=10).collect()}
    assert (got[1].contaminated, got[1].near_items, got[1].n_near) == (False, ["10", "7"], 2)
    assert (got[2].contaminated, got[2]["items"], got[2].near_items) == (True, ["7"], ["10"])
    assert got[3].near_items == got[4].near_items == [] and got[5]["items"] == ["8"] and got[5].n_near == 0
    alone = dc.find_contamination(spark.createDataFrame(rows[:1], DOCS), items, within=10).first()
    assert alone.near_items == ["10", "7"]  # replaced words occur nowhere


def test_words_that_polynomial_hashes_confuse(spark):
    one, other = twins()
    docs, items = [(1, f"x {one} y"), (2, f"x {other} y")], [(7, one)]
    got = dc.find_contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert sorted(map(tuple, got.drop("items", "k1").collect()), key=str) == brute(docs, items)
