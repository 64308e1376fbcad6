import itertools
import math
import os
import random
import zlib

import numpy as np
import pytest

from skytide.llm import langid

SCHEMA = "doc_id bigint, text string, lang string"
SYLLABLES = {"en": ["the", "ing", "ou", "th", "er"], "fr": ["eau", "tion", "ou", "é", "le"], "de": ["sch", "ung", "ö", "er", "en"]}


@pytest.fixture(scope="module")
def vocabulary(tmp_path_factory):
    import base64

    path = tmp_path_factory.mktemp("vocabulary") / "pieces.tiktoken"
    pieces = sorted({p for s in SYLLABLES.values() for p in s} | {" " + p for p in "abcdefgh"})
    path.write_text("\n".join(f"{base64.b64encode(p.encode()).decode()} {k}" for k, p in enumerate(pieces)))
    return str(path)


def documents(n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(4, 40))]
        rows.append((i, " ".join(words), lang))
    return rows


def marginal(word, pieces, p):
    """Sum over every way to cut the word."""
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        edges = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(word)]
        parts = [word[a:b] for a, b in zip(edges, edges[1:])]
        total += math.prod(p[pieces.index(x)] if x in pieces else 0.0 for x in parts)
    return total


def test_forward_sums_all_segmentations_and_counts_agree():
    pieces = sorted({bytes([b]) for b in b"abcde"} | {b"ab", b"bc", b"abc", b"cde", b"dea", b"abcdeabc"})
    rng = np.random.default_rng(3)
    p = rng.random((len(pieces), 2))
    words = [b"a", b"abc", b"abcdeabc", b"edcba", b"bcdea", b"abcdeabcd"]
    lattice = langid.Lattice(words, langid.PieceTable(pieces))
    got = np.exp(lattice.log_likelihood(p))
    for k, word in enumerate(words):
        assert got[k] == pytest.approx([marginal(word, pieces, p[:, 0]), marginal(word, pieces, p[:, 1])])
    # expected counts are the derivative of the log likelihood by log probability
    weights = rng.random((len(words), 2))
    counts = lattice.expected_counts(p, weights)
    for k in range(len(pieces)):
        more = p.copy()
        more[k] *= 1 + 1e-6
        slope = ((lattice.log_likelihood(more) - lattice.log_likelihood(p)) * weights).sum(axis=0) / 1e-6
        assert counts[k] == pytest.approx(slope, abs=1e-4)


def test_held_out_accuracy_and_und(spark, vocabulary):
    rows = documents() + [(900, None, "en"), (901, "", "en"), (902, "12 34 ²½ ...", "fr"), (903, "éÉ" * 300, None), (None, "the the", "en"), (904, "x" * 40_000, "de")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.doc_id: r for r in langid.identify(frame, vocabulary).collect()}
    assert len(got) == len(rows)
    for i in (900, 901, 902):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[903].lang_pred == "fr" and got[None].lang_pred == "en" and got[None].held_out is False
    held = [(i, lang) for i, _, lang in rows[:300] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i, _ in held) and len(held) > 50
    assert sum(got[i].lang_pred == lang for i, lang in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_are_no_input_of_a_prediction(spark, vocabulary):
    rows = documents(80)
    model = langid.fit(spark.createDataFrame(rows, SCHEMA), vocabulary=vocabulary)
    swapped = [(i + 1000, t, "xx") for i, t, _ in rows]
    one = [r.lang_pred for r in langid.predict(spark.createDataFrame(rows, SCHEMA).coalesce(1), model).collect()]
    two = [r.lang_pred for r in langid.predict(spark.createDataFrame(swapped, SCHEMA).coalesce(1), model).collect()]
    assert one == two


def test_nothing_to_learn_from(spark, vocabulary):
    assert langid.identify(spark.createDataFrame([], SCHEMA), vocabulary).collect() == []
    got = langid.identify(spark.createDataFrame([(1, "the", None), (1, "the", None)], SCHEMA), vocabulary).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2


@pytest.mark.skipif(not os.path.exists(langid.VOCABULARY), reason="no public vocabulary here")
def test_public_vocabulary():
    pieces = langid.read_pieces()
    assert len(pieces) > 5000 and all(len(p) <= langid.PIECE_BYTES for p in pieces)
