"""Texts of an Arrow batch as one byte array, with words and rolling hashes.

Everything here works on a whole block of documents at once: bytes are one
numpy array, words are arrays of start and end positions, and the hash of any
byte range is two look-ups in a table of prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 4 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> _U(31))
    h = h * _U(0x7FB5D329728EA185)
    h ^= h >> _U(27)
    h = h * _U(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U(33))


def byte_values(lower: bool) -> np.ndarray:
    """A 64-bit value for each byte; A-Z share the values of a-z if ``lower``."""
    values = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
    if lower:
        values[65:91] = values[97:123]
    return values


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, up to ``n``."""
    have = _tables.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        if size <= 4 * BLOCK_BYTES:
            _tables[0] = tuple(out)
        return tuple(out)
    return have


class Rolling:
    """Hashes of ranges of ``values`` (64-bit numbers), by prefix sums: a polynomial modulo
    2^64, so ranges of over 1,000 values made to that end can collide. For words take
    ``word_hashes``."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        up, self.down = _powers(n + 1)
        self.prefix = np.zeros(n + 1, _U)
        np.cumsum(values * up[:n], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype(_U))


class Block:
    """Some documents of a batch: ``data`` holds their bytes end to end, document
    k at ``bounds[k]:bounds[k + 1]``; ``first`` is its row in the batch. Null
    texts count as empty; ``null`` marks them."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int, null: np.ndarray):
        self.data, self.bounds, self.first, self.null = data, bounds, first, null

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text(self, k: int) -> bytes:
        return self.data[self.bounds[k] : self.bounds[k + 1]].tobytes()

    def words(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of each run of bytes that ``inside`` (a table
        of 256 booleans) admits; runs end with their document."""
        n = len(self.data)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, none
        mask = inside[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.bounds] = True
        starts = mask.copy()
        starts[1:] &= ~mask[:-1] | edge[1:n]
        ends = mask.copy()
        ends[:-1] &= ~mask[1:] | edge[1:n]
        start = np.flatnonzero(starts)
        return start, np.flatnonzero(ends) + 1, np.searchsorted(self.bounds, start, side="right") - 1


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(block: Block, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (A-Z as a-z) and its document. The words of a block
    are told apart by their bytes; only different words are hashed, each as a whole."""
    start, end, doc = block.words(inside)
    letters = _LOWER[block.data[inside[block.data]]]
    offsets = np.concatenate([[0], np.cumsum(end - start)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], _U)
    return hashes[np.asarray(coded.indices)] if len(start) else np.zeros(0, _U), doc


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of up to ``limit`` bytes (one longer text
    makes a block of its own)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    n = len(column)
    if not n:
        return
    null = np.asarray(column.is_null())
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lengths = np.where(null, 0, np.diff(bounds))
    if not np.array_equal(lengths, np.diff(bounds)):  # bytes under a null
        whole = np.concatenate([whole[a : a + k] for a, k in zip(bounds[:-1], lengths)] or [whole[:0]])
        bounds = np.concatenate([[0], np.cumsum(lengths)])
    at = 0
    while at < n:
        end = int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1
        end = min(n, max(end, at + 1))
        own = bounds[at : end + 1]
        yield Block(whole[own[0] : own[-1]], own - own[0], at, null[at:end])
        at = end


def pack(sorted_keys: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as the byte planes of their differences, which
    the shuffle's compression shrinks."""
    steps = np.diff(sorted_keys, prepend=_U(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(_U).ravel(), dtype=_U)


def table_of(ranges: list[tuple[int, int]], invert: bool = False) -> np.ndarray:
    """A table of 256 booleans, true for bytes within the inclusive ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return ~out if invert else out
