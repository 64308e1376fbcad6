"""Exact dedup with Patricia tries: whole byte strings decide, terminal nodes own their group.

Texts are equal if they are so without whitespace. Each map task inserts the full
bytes of its texts into compressed radix tries, dealt by length and content hash.
A terminal node stands for one text: it keeps the best identifier met so far (most
code points, then smallest id), the number of its rows, and a name. Rows leave at
once with their terminal's name; so a group of any size costs a task one node.

Memory is bounded by ``held_bytes`` of strings: beyond it the heaviest subtrees are
spilled, that is, their terminals are written out and forgotten. A text that comes
again gets a new terminal.

A length and hash with one terminal in the whole corpus is settled. The strings of
all others are shuffled by length and hash, and inserted again, in that order, so
a trie holds one such key at a time. Where a key has more than ``FAN`` terminals,
they meet in groups of about ``FAN`` first, each of which sends one string on.

Nulls count as empty; empty texts are equal to each other and to texts of only
whitespace. Null ids come after all others. Of rows equal in text, code points
and id, one stays. Texts of any length are inserted whole. No rows give no rows;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skytide.session import broadcast_if_small, stage

FAN = 256
HELD_BYTES = 32 << 20
TRIES = 16
_SPACE = b" \t\n\x0b\x0c\r"
_TASK_BITS = 33
_OUT_ROWS = 4096
_OUT_BYTES = 4 << 20


class Node:
    """``text[start:end]`` is the label of the edge that leads here."""

    __slots__ = ("text", "start", "end", "children", "terminal")

    def __init__(self, text: bytes, start: int, end: int):
        self.text, self.start, self.end = text, start, end
        self.children: dict[int, Node] = {}
        self.terminal = None


def _common(a: bytes, start: int, b: bytes, pos: int, limit: int) -> int:
    """How many of up to ``limit`` bytes of ``a`` from ``start`` and of ``b`` from ``pos`` agree."""
    differs = np.frombuffer(a, np.uint8, limit, start) != np.frombuffer(b, np.uint8, limit, pos)
    at = int(differs.argmax())
    return at if differs[at] else limit


class Trie:
    """A compressed radix trie; one node per text and per place where texts part."""

    def __init__(self):
        self.root = Node(b"", 0, 0)

    def node(self, text: bytes) -> Node:
        """The node at the end of ``text``, made if it is not there."""
        here, pos = self.root, 0
        while pos < len(text):
            child = here.children.get(text[pos])
            if child is None:
                here.children[text[pos]] = leaf = Node(text, pos, len(text))
                return leaf
            size = child.end - child.start
            if not text.startswith(child.text[child.start : child.end], pos):
                size = _common(child.text, child.start, text, pos, min(size, len(text) - pos))
                fork = Node(child.text, child.start, child.start + size)
                child.start += size
                fork.children[child.text[child.start]] = child
                here.children[text[pos]] = child = fork
            here, pos = child, pos + size
        return here

    def terminals(self, first: int | None = None):
        """The terminals under the root, or only those of the subtree that begins with byte ``first``."""
        open_ = [self.root] if first is None else [self.root.children[first]]
        while open_:
            node = open_.pop()
            if node.terminal is not None:
                yield node.terminal
            open_.extend(node.children.values())


class Owner:
    """What a terminal node keeps of the rows that ended in it."""

    __slots__ = ("name", "text", "sha", "best", "n")

    def __init__(self, name: int, text: bytes, sha: str):
        self.name, self.text, self.sha, self.best, self.n = name, text, sha, None, 0

    def add(self, points: int, doc_id, row: int, n: int) -> None:
        rank = (-points, doc_id is None, 0 if doc_id is None else doc_id, row)
        if self.best is None or rank < self.best:
            self.best = rank
        self.n += n

    def fields(self, name: int):
        minus_points, missing, doc_id, row = self.best
        return name, self.name, None if missing else doc_id, -minus_points, row, self.n, len(self.text), _content(self.sha), self.sha, self.text


def _content(sha: str) -> int:
    return int.from_bytes(bytes.fromhex(sha[:16]), "big", signed=True)


class _Out:
    """Rows gathered into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.held = schema, [], 0

    def put(self, row) -> bool:
        self.rows.append(row)
        self.held += len(row[-1] or b"")
        return len(self.rows) >= _OUT_ROWS or self.held >= _OUT_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * len(self.schema)
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


def _layout(id_ddl: str, id_type: pa.DataType) -> tuple[str, pa.Schema]:
    """Rows of both kinds: a row of ``node`` alone says where a document (``row``) or an
    earlier node (``name``) ended; one with ``n`` is the node itself with its owner."""
    ddl = f"name bigint, node bigint, doc_id {id_ddl}, points bigint, row bigint, n bigint, size bigint, content bigint, text_sha256 string, string binary"
    big = pa.int64()
    fields = zip([c.split()[0] for c in ddl.split(", ")], [big, big, id_type, big, big, big, big, big, pa.string(), pa.binary()])
    return ddl, pa.schema(list(fields))


def _insert(schema: pa.Schema, held_bytes: int):
    """Batches of id, code points and text to rows of documents and terminals."""

    def run(batches):
        count = TaskContext.get().partitionId() << _TASK_BITS
        out = _Out(schema)
        tries = [Trie() for _ in range(TRIES)]
        weights: dict[tuple[int, int], int] = {}
        held = 0

        def spill(part: int, first: int):
            """A subtree's terminals, after which it is gone; -1 is the root's own text."""
            trie = tries[part]
            if first < 0:
                yield trie.root.terminal
                trie.root.terminal = None
            else:
                yield from trie.terminals(first)
                del trie.root.children[first]

        for batch in batches:
            ids, points = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, n_points, text in zip(ids, points, batch.column(2).cast(pa.large_binary())):
                bare = (text.as_py() or b"").translate(None, _SPACE)
                sha = hashlib.sha256(bare).hexdigest()
                part = (len(bare) ^ int(sha[:8], 16)) % TRIES
                node = tries[part].node(bare)
                if node.terminal is None:
                    node.terminal = Owner(count, bare, sha)
                    count += 1
                    first = bare[0] if bare else -1
                    weights[part, first] = weights.get((part, first), 0) + len(bare) + 200
                    held += len(bare) + 200
                node.terminal.add(n_points, doc_id, count, 1)
                full = out.put((None, node.terminal.name, doc_id, n_points, count, None, None, None, None, None))
                count += 1
                if full:
                    yield out.batch()
                while held > held_bytes:
                    heaviest = max(weights, key=weights.get)
                    held -= weights.pop(heaviest)
                    for owner in spill(*heaviest):
                        if out.put(owner.fields(owner.name)):
                            yield out.batch()
        for subtree in weights:
            for owner in spill(*subtree):
                if out.put(owner.fields(owner.name)):
                    yield out.batch()
        if out.rows:
            yield out.batch()

    return run


def _merge(schema: pa.Schema):
    """Terminals in the order of their key to the node where each ends, and those nodes."""

    def run(batches):
        out, trie, key = _Out(schema), Trie(), None
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("size", "content", "part", "name", "doc_id", "points", "row", "n", "text_sha256")]
            for *here, name, doc_id, points, row, n, sha, text in zip(*columns, batch.column("string")):
                if here != key:
                    for owner in trie.terminals():
                        if out.put(owner.fields(owner.name)):
                            yield out.batch()
                    trie, key = Trie(), here
                text = text.as_py()
                node = trie.node(text)
                if node.terminal is None:
                    node.terminal = Owner(name, text, sha)
                node.terminal.add(points, doc_id, row, n)
                if out.put((name, node.terminal.name, None, None, None, None, None, None, None, None)):
                    yield out.batch()
        for owner in trie.terminals():
            if out.put(owner.fields(owner.name)):
                yield out.batch()
        if out.rows:
            yield out.batch()

    return run


def _met(terminals: DataFrame, part, ddl: str, schema: pa.Schema, label: str) -> tuple[DataFrame, DataFrame]:
    """Where terminals of one key and part end, and the nodes they end in."""
    key = ["size", "content", "part"]
    dealt = terminals.withColumn("part", part).repartition(*key).sortWithinPartitions(*key)
    met = stage(dealt.mapInArrow(_merge(schema), ddl), label)
    return met.where("n IS NULL").select("name", "node"), met.where("n IS NOT NULL")


def text_owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_bytes: int = HELD_BYTES, fan: int = FAN) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``; a group is
    the documents with equal text, ``keep_id`` the one of them that stays."""
    ddl, schema = _layout(dict(docs.dtypes)[id_col], to_arrow_type(docs.schema[id_col].dataType))
    points = F.coalesce(F.char_length(text_col), F.lit(0)).cast("bigint")
    texts = docs.select(F.col(id_col).alias("doc_id"), points.alias("points"), F.col(text_col).cast("string").alias("text"))
    inserted = stage(texts.mapInArrow(_insert(schema, held_bytes), ddl), "trie-nodes")
    documents = inserted.where("n IS NULL").select("node", "doc_id", "row")
    nodes = inserted.where("n IS NOT NULL")

    keys = nodes.groupBy("size", "content").agg(F.count(F.lit(1)).alias("n_nodes")).where("n_nodes > 1")
    several = nodes.join(broadcast_if_small(stage(keys, "trie-keys")), ["size", "content"])
    columns = nodes.columns
    groups = F.ceil(F.col("n_nodes") / fan).cast("bigint")
    part = F.when(F.col("n_nodes") > fan, F.pmod(F.xxhash64("name"), groups))
    early, early_nodes = _met(several.where(F.col("n_nodes") > fan), part, ddl, schema, "trie-hot")
    rest = several.where(F.col("n_nodes") <= fan).select(*columns).unionByName(early_nodes.select(*columns))
    late, late_nodes = _met(rest, F.lit(0), ddl, schema, "trie-met")

    early = early.select("name", F.col("node").alias("via"))
    ends = late.select(F.col("name").alias("via"), F.col("node").alias("end"))
    ends = ends.join(early, "via", "left").select(F.coalesce("name", "via").alias("node"), "end")
    owner = F.struct("doc_id", "row", "n", "text_sha256")
    ends = ends.join(late_nodes.select(F.col("node").alias("end"), owner.alias("met")), "end").select("node", "met")
    owners = nodes.select("node", owner.alias("own")).join(ends, "node", "left")
    owners = owners.select("node", F.coalesce("met", "own").alias("owner"))
    return documents.join(owners, "node").select(
        "doc_id",
        F.col("owner.doc_id").alias("keep_id"),
        F.col("owner.n").alias("group_size"),
        (F.col("row") == F.col("owner.row")).alias("kept"),
        F.col("owner.text_sha256").alias("text_sha256"),
    )
