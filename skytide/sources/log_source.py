"""Streaming source ``topic_log``: a Parquet topic log read by offset ranges.

Its offsets are those of Kafka's source, ``{topic: {partition: next offset}}``, and
so is its admission: a micro-batch takes up to ``perTrigger`` messages, dealt to the
partitions in proportion to what each has left, whatever the files are.
"""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from skytide.session import open_filesystem
from skytide.sources.log_index import Held, list_parquet, ranges_of_file, read_index, topic_of

Offsets = dict[str, dict[str, int]]
PACK_BYTES = 32 << 20
READ_BYTES = 1 << 20  # of a column at a time: a whole row group of bodies would grow with the log's files


class FileRanges(InputPartition):
    """Files with the offset ranges ``(topic, partition, start, end)`` wanted of each."""

    def __init__(self, files: list[tuple[str, list[tuple[str, int, int, int]]]]):
        self.files = files


def admit(start: Offsets, ends: Offsets, limit: int | None) -> Offsets:
    """The offsets after the next ``limit`` messages. Each partition gets its share of
    the limit, rounded down, and what is left over goes to the first ones with more."""
    left = {(t, p): max(0, end - start.get(t, {}).get(p, 0)) for t, of_topic in ends.items() for p, end in of_topic.items()}
    total = sum(left.values())
    granted = dict(left)
    if limit is not None and total > limit:
        granted = {key: n * limit // total for key, n in left.items()}
        spare = limit - sum(granted.values())
        for key in sorted(left):
            more = min(spare, left[key] - granted[key], 1)
            granted[key] += more
            spare -= more
    out = {t: dict(of_topic) for t, of_topic in start.items()}
    for (t, p), n in granted.items():
        out.setdefault(t, {})[p] = out.get(t, {}).get(p, 0) + n
    return out


class TopicLogReader(DataSourceStreamReader):
    """Runs beside the driver: it lists files and plans ranges; messages are read by tasks."""

    def __init__(self, options, schema: StructType):
        self.path, self.struct = options["path"], schema
        self.topics = set(json.loads(options["topics"]))
        self.limit = int(options["perTrigger"]) if options.get("perTrigger") else None
        self.start = {(t, p): o for t, p, o in json.loads(options.get("start", "[]"))}
        self.until = {(t, p): o for t, p, o in json.loads(options["until"])} if options.get("until") else None
        self.sizes: dict[str, int] = {}
        self.held: list[Held] = []
        self.position: Offsets | None = None

    def _refresh(self) -> None:
        listed = list_parquet(self.path, self.topics)
        if not self.sizes:
            self.held = [h for h in read_index(self.path) if h.file in listed]
            self.sizes = {h.file: listed[h.file] for h in self.held}
        new = sorted(set(listed) - set(self.sizes))
        with ThreadPoolExecutor(16) as pool:
            for rows in pool.map(lambda f: ranges_of_file(self.path, f), new):
                self.held.extend(rows)
        self.sizes.update({f: listed[f] for f in new})

    def _bounds(self) -> tuple[Offsets, Offsets]:
        lows: Offsets = {}
        ends: Offsets = {}
        for h in self.held:
            if h.topic in self.topics:
                low, end, p = lows.setdefault(h.topic, {}), ends.setdefault(h.topic, {}), str(h.partition)
                low[p], end[p] = min(low.get(p, h.lo), h.lo), max(end.get(p, h.hi), h.hi)
        return lows, ends

    def _first(self) -> Offsets:
        lows, _ = self._bounds()
        for (t, p), offset in self.start.items():
            if t in self.topics:
                of_topic = lows.setdefault(t, {})
                of_topic[str(p)] = max(offset, of_topic.get(str(p), offset))
        return lows

    def initialOffset(self) -> Offsets:
        self._refresh()
        self.position = self._first()
        return self.position

    def latestOffset(self) -> Offsets:
        self._refresh()
        if self.position is None:
            self.position = self._first()
        lows, ends = self._bounds()
        if self.until is not None:
            ends = {t: {p: min(o, self.until.get((t, int(p)), 0)) for p, o in of_topic.items()} for t, of_topic in ends.items()}
        # a partition that has appeared since begins at its first offset
        here = {t: {**lows.get(t, {}), **self.position.get(t, {})} for t in {*lows, *self.position}}
        self.position = admit(here, ends, self.limit)
        return self.position

    def partitions(self, start: Offsets, end: Offsets):
        if not self.sizes:
            self._refresh()
        self.position = end
        wanted: dict[str, list[tuple[str, int, int, int]]] = {}
        for h in self.held:
            last = end.get(h.topic, {}).get(str(h.partition))
            if last is None:
                continue
            first = start.get(h.topic, {}).get(str(h.partition), h.lo)
            if h.lo < last and first < h.hi:
                wanted.setdefault(h.file, []).append((h.topic, h.partition, max(first, h.lo), min(last, h.hi)))
        packed, current, weight = [], [], 0
        for file in sorted(wanted):
            if current and weight + self.sizes[file] > PACK_BYTES:
                packed.append(FileRanges(current))
                current, weight = [], 0
            current.append((file, wanted[file]))
            weight += self.sizes[file]
        return packed + [FileRanges(current)] * bool(current)

    def read(self, partition: FileRanges):
        filesystem, inner = open_filesystem(self.path)
        target = to_arrow_schema(self.struct)
        for file, ranges in partition.files:
            source = pq.ParquetFile(filesystem.open_input_file(f"{inner.rstrip('/')}/{file}"), buffer_size=READ_BYTES)
            lowest, highest = min(r[2] for r in ranges), max(r[3] for r in ranges)
            at = next(i for i in range(len(source.schema)) if source.schema.column(i).path == "offset")
            groups = []
            for g in range(source.num_row_groups):
                stats = source.metadata.row_group(g).column(at).statistics
                if stats is None or not stats.has_min_max or (stats.min < highest and stats.max >= lowest):
                    groups.append(g)
            for batch in source.iter_batches(row_groups=groups, batch_size=4096):
                yield from _within(pa.Table.from_batches([batch]), topic_of(file), ranges, target).to_batches()

    def commit(self, end: Offsets) -> None:
        pass


def _within(table: pa.Table, topic: str | None, ranges, target: pa.Schema) -> pa.Table:
    if topic is not None:
        table = table.append_column("topic", pa.array([topic] * len(table), pa.string()))
    keep = pa.array([False] * len(table))
    for t, p, start, end in ranges:
        offset = table.column("offset")
        here = pc.and_(pc.and_(pc.equal(table.column("topic"), t), pc.equal(table.column("partition"), p)), pc.and_(pc.greater_equal(offset, start), pc.less(offset, end)))
        keep = pc.or_(keep, here)
    kept = table.filter(keep)
    return pa.table([_as(kept.column(f.name), f.type) for f in target], schema=target)


def _as(column: pa.ChunkedArray, kind: pa.DataType) -> pa.ChunkedArray:
    if pa.types.is_timestamp(kind) and pa.types.is_timestamp(column.type) and column.type.tz is None:
        column = pc.assume_timezone(column.cast(pa.timestamp("us"), safe=False), "UTC")
    return column.cast(kind, safe=not pa.types.is_timestamp(kind))


class TopicLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def streamReader(self, schema: StructType) -> TopicLogReader:
        return TopicLogReader(self.options, schema)


_registered: set[str] = set()


def register(spark: SparkSession) -> None:
    """Make the source known to the application. Its planner is a process of the driver's
    machine that does not see files sent to the tasks, so it is told where this package lies."""
    app = spark.sparkContext.applicationId
    if app in _registered:
        return
    _registered.add(app)
    environment = spark.sparkContext.environment
    before = environment.get("PYTHONPATH")
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment["PYTHONPATH"] = os.pathsep.join([here] + [before] * bool(before))
    try:
        spark.dataSource.register(TopicLogSource)
    finally:
        del environment["PYTHONPATH"]
        if before is not None:
            environment["PYTHONPATH"] = before
