"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A
word's probability is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words. Pieces get their
probabilities by expectation-maximisation: expected piece counts over all
segmentations (forward and backward), summed by Spark over the word counts of a
bounded sample of labelled documents (``sample_docs`` a language, chosen by the
hash of the id).

The model has languages x pieces numbers, whatever the corpus; it is what the
driver holds and broadcasts. Scoring is one pass without a shuffle. Words are
runs of letters in lower case; a run of more than 32 UTF-8 bytes is scored in
pieces of 32. Distinct words are scored together in arrays, and a bounded cache
holds the scores of words seen before.

Null texts and texts without a letter give ``und`` and score 0, as does every
text if there is nothing to learn from. Ties go to the first language in code
point order. Repeated rows, null ids and extra columns pass through unharmed;
documents with a null id are not learned from.
"""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
SAMPLE_DOCS = 1500
ROUNDS = 3
WORD_BYTES = 32
PIECE_BYTES = 8
FLOOR = 1e-8
UNKNOWN = "und"
_CACHE_WORDS = 200_000
_CHUNK_CHARS = 4 << 20
_LETTERS = re.compile(r"[^\W\d_]+")
_U = np.uint64
_MASKS = [_U((1 << (8 * n)) - 1) for n in range(PIECE_BYTES)] + [_U(0xFFFFFFFFFFFFFFFF)]


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """Distinct lower-case letter pieces of up to 8 bytes, and every single byte."""
    filesystem, inner = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    with filesystem.open_input_stream(inner) as stream:
        tokens = [base64.b64decode(line.split()[0]) for line in stream.read().splitlines() if line.strip()]
    pieces = {bytes([b]) for b in range(256)}
    for token in tokens:
        try:
            text = token.decode().strip().lower()
        except UnicodeDecodeError:
            continue
        if text.isalpha() and len(text.encode()) <= PIECE_BYTES:
            pieces.add(text.encode())
    return sorted(pieces)


class PieceTable:
    """Piece numbers by their bytes, packed in 64 bits, in an open hash table."""

    def __init__(self, pieces: list[bytes]):
        self.n = len(pieces)
        self.bits = max(4, (8 * self.n).bit_length())
        self.keys = np.zeros(1 << self.bits, _U)
        self.ids = np.full(1 << self.bits, -1, np.int32)
        for k, piece in enumerate(pieces):
            key = int.from_bytes(piece, "little") | len(piece) << 64
            slot = self._slot(np.array([key & (1 << 64) - 1], _U), len(piece))[0]
            while self.ids[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.keys[slot], self.ids[slot] = key & (1 << 64) - 1, k
        self.size = np.array([len(p) for p in pieces], np.int8)

    def _slot(self, keys: np.ndarray, size: int) -> np.ndarray:
        return ((keys + _U(size)) * _U(0x9E3779B97F4A7C15) >> _U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose key is a piece of ``size`` bytes, and the piece numbers."""
        slot, rows = self._slot(keys, size), np.arange(len(keys))
        found, numbers = [], []
        while len(rows):
            ids = self.ids[slot]
            hit = (ids >= 0) & (self.keys[slot] == keys) & (self.size[ids] == size)
            found.append(rows[hit])
            numbers.append(ids[hit])
            on = (ids >= 0) & ~hit
            rows, keys, slot = rows[on], keys[on], slot[on] + 1 & (1 << self.bits) - 1
        return np.concatenate(found or [rows]), np.concatenate(numbers or [rows]).astype(np.int64)


class Lattice:
    """All segmentations of many words at once; words are sorted by falling length."""

    def __init__(self, words: list[bytes], table: PieceTable):
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.order = np.argsort(-self.lengths, kind="stable")
        ordered = self.lengths[self.order]
        longest = int(ordered[0]) if len(ordered) else 0
        grid = np.zeros((len(words), longest + PIECE_BYTES), np.uint8)
        joined = np.frombuffer(b"".join(words[k] for k in self.order), np.uint8)
        grid[np.arange(grid.shape[1]) < ordered[:, None]] = joined
        self.longest, self.ordered, self.arcs = longest, ordered, []
        for t in range(longest):
            live = int(np.searchsorted(-ordered, -t, side="left"))
            keys = np.ascontiguousarray(grid[:live, t : t + PIECE_BYTES]).view(_U).ravel()
            for size in range(1, min(PIECE_BYTES, longest - t) + 1):
                reach = int(np.searchsorted(-ordered, -(t + size), side="right"))
                rows, ids = table.find(keys[:reach] & _MASKS[size], size)
                if len(rows):
                    self.arcs.append((t, size, rows, ids))

    def forward(self, probabilities: np.ndarray) -> np.ndarray:
        alpha = np.zeros((self.longest + 1, len(self.ordered), probabilities.shape[1]))
        alpha[0] = 1
        for t, size, rows, ids in self.arcs:
            alpha[t + size, rows] += alpha[t, rows] * probabilities[ids]
        return alpha

    def backward(self, probabilities: np.ndarray) -> np.ndarray:
        beta = np.zeros((self.longest + 1, len(self.ordered), probabilities.shape[1]))
        beta[self.ordered, np.arange(len(self.ordered))] = 1
        for t, size, rows, ids in reversed(self.arcs):
            beta[t, rows] += probabilities[ids] * beta[t + size, rows]
        return beta

    def log_likelihood(self, probabilities: np.ndarray) -> np.ndarray:
        """words x languages, in the order the words were given."""
        alpha = self.forward(probabilities)
        total = alpha[self.ordered, np.arange(len(self.ordered))]
        out = np.empty_like(total)
        out[self.order] = np.log(np.maximum(total, 1e-300))
        return out

    def expected_counts(self, probabilities: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """pieces x languages, for ``weights`` (words x languages) in the order given."""
        alpha, beta = self.forward(probabilities), self.backward(probabilities)
        scale = weights[self.order] / np.maximum(beta[0], 1e-300)
        out = np.zeros_like(probabilities)
        for t, size, rows, ids in self.arcs:
            np.add.at(out, ids, alpha[t, rows] * beta[t + size, rows] * scale[rows] * probabilities[ids])
        return out


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _pieces_of_word(word: str) -> list[bytes]:
    """The word's bytes, a long run in parts; none for digits that are not letters."""
    raw = word.encode() if word.isalpha() else "".join(c for c in word if c.isalpha()).encode()
    return [raw[a : a + WORD_BYTES] for a in range(0, len(raw), WORD_BYTES)]


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[bytes]
    probabilities: np.ndarray  # pieces x languages


class WordScores:
    """Scores of words under a model; remembers a bounded number of words."""

    def __init__(self, model: LanguageModel):
        self.model, self.table = model, PieceTable(model.pieces)
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def of(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.rows))
        if len(self.rows) + len(new) > _CACHE_WORDS:
            self.rows, self.scores = {}, self.scores[:0]
            new = list(set(words))
        for a in range(0, len(new), 50_000):
            part = new[a : a + 50_000]
            cut = [_pieces_of_word(w) for w in part]
            flat = [p for parts in cut for p in parts]
            each = Lattice(flat, self.table).log_likelihood(self.model.probabilities) if flat else self.scores[:0]
            owner = np.repeat(np.arange(len(part)), [len(c) for c in cut])
            total = np.zeros((len(part), len(self.model.languages)))
            np.add.at(total, owner, each)
            total[[not c for c in cut]] = np.nan  # no letter at all
            base = len(self.scores)
            self.scores = np.concatenate([self.scores, total])
            self.rows.update(zip(part, range(base, base + len(part))))
        return self.scores[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))]


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Documents to learn from: a language, and crc32 of the id not 2 modulo 4."""
    remainder = F.crc32(F.col(id_col).cast("string")) % 4
    return docs.where((remainder != 2) & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    vocabulary: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS,
) -> LanguageModel:
    """Learn from at most about ``sample_docs`` documents of each language."""
    spark = docs.sparkSession
    labelled = _labelled(docs, id_col, text_col, lang_col)
    sizes = {r.lang: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    pieces = read_pieces(vocabulary)
    probabilities = np.full((len(pieces), max(1, len(languages))), 1 / len(pieces))
    if not languages:
        return LanguageModel([], pieces, probabilities)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample_docs / sizes[lang]))])
    sample = labelled.where(place < F.element_at(share, F.col("lang")) * (1 << 20))
    number = {lang: k for k, lang in enumerate(languages)}

    def count_words(batches):
        for batch in batches:
            seen: dict[tuple[str, bytes], int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in words_of(text or ""):
                    for part in _pieces_of_word(word):
                        seen[lang, part] = seen.get((lang, part), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.binary()), pa.array(list(seen.values()), pa.int64())],
                ["lang", "word", "n"],
            )

    counts = (
        sample.select("lang", "text").mapInArrow(count_words, "lang string, word binary, n bigint")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")).persist()
    )
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, probabilities))

        def expect(batches):
            own_pieces, current = shared.value
            table, total = PieceTable(own_pieces), np.zeros_like(current)
            for batch in batches:
                words = batch.column(1).to_pylist()
                weights = np.zeros((len(words), current.shape[1]))
                weights[np.arange(len(words)), [number[x] for x in batch.column(0).to_pylist()]] = np.asarray(batch.column(2))
                if words:
                    total += Lattice(words, table).expected_counts(current, weights)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], ["piece", "lang", "n"])

        expected = np.zeros_like(probabilities)
        summed = counts.mapInArrow(expect, "piece bigint, lang bigint, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        for row in summed.collect():
            expected[row.piece, row.lang] = round(row["n"], 6)
        probabilities = (expected + 0.01) / (expected + 0.01).sum(axis=0)
        probabilities = np.maximum(probabilities, FLOOR)
    counts.unpersist()
    return LanguageModel(languages, pieces, probabilities)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the language's share of the likelihood of all."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in names) + ", lang_pred string, score double"
    at = names.index(text_col)

    def score(batches):
        own = shared.value
        words = WordScores(own) if own.languages else None
        for batch in batches:
            texts = batch.column(at).to_pylist()
            pred, value = [UNKNOWN] * len(texts), np.zeros(len(texts))
            first = 0
            while words and first < len(texts):
                last, chars, each = first, 0, []
                while last < len(texts) and (last == first or chars + len(texts[last] or "") <= _CHUNK_CHARS):
                    each.append(words_of(texts[last] or ""))
                    chars += len(texts[last] or "")
                    last += 1
                sizes = np.array([len(w) for w in each])
                flat = words.of([w for ws in each for w in ws])
                real = ~np.isnan(flat[:, 0])
                doc = np.repeat(np.arange(len(each)), sizes)[real]
                total = np.stack([np.bincount(doc, flat[real, k], len(each)) for k in range(len(own.languages))], axis=1)
                known = np.bincount(doc, minlength=len(each)) > 0
                best = total.argmax(axis=1)
                share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                for k in np.flatnonzero(known):
                    pred[first + k], value[first + k] = own.languages[best[k]], share[k]
                first = last
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(value)], [*names, "lang_pred", "score"])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(score, schema)


def identify(docs: DataFrame, vocabulary: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Learn and predict: ``doc_id, held_out, lang_pred, score``."""
    model = fit(docs, vocabulary=vocabulary, sample_docs=sample_docs)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
