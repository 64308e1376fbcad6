"""Periodic runs of words by recursive frequency splitting, and texts without their repeats.

A run is a stretch of consecutive words that repeats with smallest period q (words q
apart are identical), is at least ``least_words`` and ``times * q`` long, and cannot
be extended by a neighbour. So every word of a run occurs in it ``times`` times at
least. Hence:

* A word that occurs less often than that within its segment (at first the whole
  text) is in no run of it, and splits the segment; parts too short for a run go.
  In the parts other words may now be too rare, so it is done again until nothing
  splits. All texts of a block are split together.
* Each surviving segment is scanned lag by lag. For lags from B = 2^k to 2B - 1
  every run holds a multiple of B from which B words recur at the lag; whole windows
  are compared by their exact class (classes of doubled windows are numbered pairs of
  classes), so one comparison per word finds the lags of a k that can have runs.
  Windows that a found run of a period up to B explains cannot belong to a run of
  their own (its period would divide both). Only lags so found are scanned. The cost
  grows with the words times their logarithm, and with the runs.

Words are compared as bytes, not by hash. There is no shuffle: a row stays in its task.

Null and empty texts, and texts of whitespace, have no words and no runs. Repeated
rows are rows like others; ids may be null. Texts of any length are taken whole; one
longer than a block makes a block of its own. No rows give no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

LEAST_WORDS = 6
TIMES = 4
BLOCK_BYTES = 4 << 20
WORD = r"[\x20\x09-\x0D]+"


def word_classes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For the words of all texts end to end a number each, equal where the words are,
    and the bounds of each text among them. Null texts have no words."""
    parts = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
    offsets = np.asarray(parts.offsets).astype(np.int64)
    words = parts.flatten()
    real = np.asarray(pc.greater(pc.binary_length(words), 0))  # space at an end leaves an empty word
    before = np.concatenate([[0], np.cumsum(real)])
    classes = np.asarray(words.filter(pa.array(real)).dictionary_encode().indices).astype(np.int64)
    return classes, before[offsets - offsets[0]]


def surviving_segments(classes: np.ndarray, bounds: np.ndarray, times: int = TIMES, least_words: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches in which every word occurs often enough to be in a run."""
    start, end = bounds[:-1], bounds[1:]
    while True:
        long = end - start >= least_words
        start, end = start[long], end[long]
        size = end - start
        if not len(size):
            return start, end
        first = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(size)), size)
        place = np.arange(size.sum()) - first[segment] + start[segment]
        word = classes[place]
        order = np.lexsort((word, segment))
        same = (word[order][1:] == word[order][:-1]) & (segment[order][1:] == segment[order][:-1])
        group = np.concatenate([[0], np.cumsum(~same)])
        rare = np.empty(len(place), bool)
        rare[order] = np.bincount(group)[group] < times
        if not rare.any():
            return start, end
        kept = ~rare
        opens = kept.copy()
        opens[1:] &= rare[:-1] | (segment[1:] != segment[:-1])
        closes = kept.copy()
        closes[:-1] &= rare[1:] | (segment[1:] != segment[:-1])
        start, end = place[opens], place[closes] + 1


def runs_of_segment(words: np.ndarray, times: int = TIMES, least_words: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of every run."""
    n, size = len(words), 1
    window = np.unique(words, return_inverse=True)[1].astype(np.int64)  # class of the window from each place on
    found: dict[tuple[int, int], int] = {}
    reach = np.zeros(n, np.int64)  # how far the found run over a place goes
    while times * size <= n:
        lags = np.arange(size, min(2 * size, n // times + 1))
        at = np.arange(0, n - 2 * size + 1, size)
        met = np.zeros(len(lags), bool)
        step = max(1, (1 << 20) // len(lags))
        for some in np.array_split(at, range(step, len(at), step)):
            other = some[:, None] + lags[None, :]
            fits = other + size <= n
            equal = fits & (window[some][:, None] == window[np.minimum(other, len(window) - 1)])
            met |= (equal & (other + size > reach[some][:, None])).any(axis=0)
        for lag in lags[met]:
            match = words[:-lag] == words[lag:]
            edge = np.flatnonzero(np.diff(match.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            length = edge[:, 1] - edge[:, 0] + lag
            for a, m in zip(edge[:, 0][length >= max(least_words, times * lag)], length[length >= max(least_words, times * lag)]):
                if (int(a), int(m)) not in found:  # else it repeats with a divisor already
                    found[int(a), int(m)] = int(lag)
                    reach[a : a + m] = np.maximum(reach[a : a + m], a + m)
        if 2 * size > n:
            break
        pair = window[: n - 2 * size + 1] * (n + 1) + window[size : n - size + 1]
        window = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        size *= 2
    return [(a, m, q) for (a, m), q in found.items()]


def runs_by_text(classes: np.ndarray, bounds: np.ndarray, times: int = TIMES, least_words: int = LEAST_WORDS) -> dict[int, list[tuple[int, int, int]]]:
    """Number of each text that has runs, and these as start, length and period in order."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    start, end = surviving_segments(classes, bounds, times, least_words)
    owner = np.searchsorted(bounds, start, side="right") - 1
    for k, a, b in zip(owner.tolist(), start.tolist(), end.tolist()):
        runs = [(a - int(bounds[k]) + s, m, q) for s, m, q in runs_of_segment(classes[a:b], times, least_words)]
        if runs:
            out.setdefault(k, []).extend(runs)
    return {k: sorted(runs, key=lambda r: (r[0], r[2])) for k, runs in out.items()}


def _blocks(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(np.asarray(pc.binary_length(batch.column(1)).fill_null(0)).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def collapsed_runs(
    docs: DataFrame, id_col: str = "doc_id", text: str | Column = "text", times: int = TIMES, least_words: int = LEAST_WORDS,
    with_text: bool = False, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, n_runs``; ``start, length, period, exponent_milli`` of the run
    with the greatest exponent; ``runs_sha256`` of all runs; ``collapsed_sha256`` of the words that
    stay when every run keeps its first period only. ``with_text`` adds ``runs`` and ``collapsed``."""
    if times < 2 or least_words < 2:
        raise ValueError("a run repeats at least once: times and least_words must be 2 or more")
    field = docs.schema[id_col]
    longs = ["n_runs", "start", "length", "period", "exponent_milli"]
    ddl = f"doc_id {dict(docs.dtypes)[id_col]}, {', '.join(f'{c} bigint' for c in longs)}, runs_sha256 string, collapsed_sha256 string"
    names = ["doc_id", *longs, "runs_sha256", "collapsed_sha256"]
    types = [to_arrow_type(field.dataType), *[pa.int64()] * 5, pa.string(), pa.string()]
    if with_text:
        ddl += ", runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
        names += ["runs", "collapsed"]
        types += [pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])), pa.string()]

    def judged(runs, text: bytes):
        words = text.split()
        best = [None] * 4
        if runs:
            s, m, q = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
            best = [s, m, q, 1000 * m // q]
            stays = np.ones(len(words), bool)
            for a, length, period in runs:
                stays[a + period : a + length] = False
            words = [w for w, stay in zip(words, stays) if stay]
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        collapsed = b" ".join(words)
        row = [len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()]
        return row + [[dict(start=s, length=m, period=q) for s, m, q in runs], collapsed.decode()] if with_text else row

    def scan(batches):
        for batch in batches:
            for block in _blocks(batch, block_bytes):
                classes, bounds = word_classes(block.column(1))
                runs = runs_by_text(classes, bounds, times, least_words)
                texts = block.column(1).cast(pa.large_binary())
                rows = [judged(runs.get(k, []), t.as_py() or b"") for k, t in enumerate(texts)]
                columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate(types[1:])]
                yield pa.RecordBatch.from_arrays([block.column(0), *columns], names)

    text = F.col(text) if isinstance(text, str) else text
    return docs.select(F.col(id_col).alias("doc_id"), text.cast("string").alias("text")).mapInArrow(scan, ddl)


def periodic_tail(doc_id: Column, text: Column) -> Column:
    """The text of every tenth id, by checksum, with its words repeating from some word on;
    all others as they are. A probe of what the operator finds, not a part of it."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, WORD), lambda w: w != "")
    # arrays of one element, so that a lambda names what is worked out once a text
    split = F.array(F.struct(words.alias("words"), g.alias("g")))
    begun = F.transform(split, lambda t: F.struct(t["words"].alias("words"), t["g"].alias("g"), F.pmod(t["g"], F.greatest(F.size(t["words"]), F.lit(1))).alias("a")))
    period = lambda t: F.floor((F.size(t["words"]) - t["a"]) / (3 + F.pmod(t["g"], F.lit(8)))) + 1
    planned = F.transform(begun, lambda t: F.struct(t["words"].alias("words"), t["a"].alias("a"), period(t).alias("p")))

    def word(t: Column, w: Column, i: Column) -> Column:
        return F.when(i < t["a"], w).otherwise(F.get(t["words"], (t["a"] + F.pmod(i - t["a"], t["p"])).cast("int")))

    repeated = F.transform(planned, lambda t: F.array_join(F.transform(t["words"], lambda w, i: word(t, w, i)), " "))
    return F.when(F.pmod(h, F.lit(10)) == 0, F.element_at(repeated, 1)).otherwise(text)
