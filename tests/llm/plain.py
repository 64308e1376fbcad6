"""Small documents and plain Python versions to hold the operators against."""

import random

WORDS = "the of and river stone light amber quick table under north paper velvet signal ocean winter copper garden ember lantern".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))


def twins(turns=11):
    """Two different words that polynomial hashes modulo 2^64 hold to be equal."""
    one, other = "a", "b"
    for _ in range(turns):
        one, other = one + other, other + one
    return one, other


def corpus(seed=1, n=40):
    """Texts with copies, near copies, shared passages, nulls, empty and long ones."""
    rng = random.Random(seed)
    passage = prose(rng, 90)
    texts = [prose(rng, rng.randint(1, 200)) for _ in range(n)]
    texts += [texts[0]] * 3 + [None, None, "", "", " ", "é" * 300 + "ß", "x", "x"]
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(4)]
    words = texts[1].split() + prose(rng, 120).split()
    for k in range(4):
        near = list(words)
        near[5 * k + 3] = f"edit{k}"
        texts.append(" ".join(near))
    texts.append("ab" * 500)
    texts.append(prose(rng, 6000))
    return list(enumerate(texts))
