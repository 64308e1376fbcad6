"""Avro container files as a Spark data source named ``alert_avro``.

Reading: small files are packed into partitions and large plain files are cut
into byte ranges that start at the next sync marker, so neither a folder of a
million one-alert files nor one huge file ends in a single task. Gzip files
cannot be cut. Writing: one container file per task, moved into place on commit.

Options of the reader: ``avroSchema`` (JSON list of writer schemas, oldest
first, skips the reading of file headers), ``columns`` (comma-separated fields
to materialise), ``maxFiles``, ``maxPartitionBytes``, ``logicalTypes``.
Options of the writer: ``avroSchema`` (one schema), ``compression`` (one of
``null``, ``deflate``, ``snappy``, ``bzip2``, ``xz``, ``zstandard``).
"""

from __future__ import annotations

import bz2
import fnmatch
import io
import json
import lzma
import os
import posixpath
import uuid
import warnings
import zlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from skytide.session import open_filesystem, qualified, read_table_if_exists
from skytide.sources import avro_codec, avro_schema

# Container magic, file pattern of a folder scan, suffixes.
MAGIC = b"Obj\x01"
FOLDER_PATTERN = "*.avro*"
PLAIN_SUFFIX, GZIP_SUFFIX = ".avro", ".avro.gz"
PART_FOLDERS = ("batch=", "run=")

SYNC_SIZE = 16
MAX_PARTITION_BYTES = 128 * 1024 * 1024
OPEN_COST_BYTES = 4 * 1024 * 1024
FLUSH_BYTES = 32 * 1024 * 1024
MIN_PARTITION_BYTES = 256 * 1024
# Blocks are decoded side by side, so many small ones beat a few large ones.
WRITE_BLOCK_BYTES = 4 * 1024


@dataclass(frozen=True)
class Chunk:
    path: str
    start: int
    end: int


class ChunkPartition(InputPartition):
    def __init__(self, chunks: list[Chunk]):
        self.chunks = chunks


# -- listing ------------------------------------------------------------------
def list_files(path: str | list[str], max_files: int | None = None, nested: bool = True) -> list[tuple[str, int]]:
    """(path, size) of the files a path form names, in name order.

    A list names files or folders; a folder gives its own ``*.avro*`` files and
    those of its ``batch=`` and ``run=`` folders, as a transfer writes them, but
    not those of other sub-folders; anything else must be one existing file.
    """
    paths = path if isinstance(path, list) else [path]
    found = []
    for one in paths:
        filesystem, inner = open_filesystem(one)
        prefix = one[: len(one) - len(inner)] if one.endswith(inner) and one != inner else ""
        info = filesystem.get_file_info(inner)
        if info.type == pafs.FileType.File:
            found.append((one, info.size))
        elif info.type == pafs.FileType.Directory:
            inside = filesystem.get_file_info(pafs.FileSelector(inner, recursive=False))
            parts = [i.path for i in inside if nested and not i.is_file and i.base_name.startswith(PART_FOLDERS)]
            inside += [i for p in sorted(parts) for i in filesystem.get_file_info(pafs.FileSelector(p, recursive=False))]
            names = [i for i in inside if i.is_file and fnmatch.fnmatch(i.base_name, FOLDER_PATTERN)]
            found.extend((prefix + i.path, i.size) for i in sorted(names, key=lambda i: i.path))
        else:
            raise IOError(f"no such file or folder: {one}")
    return found if max_files is None else found[:max_files]


def _check_suffix(path: str) -> None:
    if not path.endswith((PLAIN_SUFFIX, GZIP_SUFFIX)):
        raise NotImplementedError(f"{path}: only {PLAIN_SUFFIX} and {GZIP_SUFFIX} files are read")


def _open(path: str):
    _check_suffix(path)
    filesystem, inner = open_filesystem(path)
    if path.endswith(GZIP_SUFFIX):
        return io.BufferedReader(filesystem.open_input_stream(inner, compression="gzip"), 1 << 18)
    return io.BufferedReader(filesystem.open_input_file(inner), 1 << 18)


# -- container format ---------------------------------------------------------
def _stream_long(stream) -> int | None:
    value = shift = 0
    while True:
        byte = stream.read(1)
        if not byte:
            return None
        value |= (byte[0] & 0x7F) << shift
        if byte[0] < 0x80:
            return (value >> 1) ^ -(value & 1)
        shift += 7


@dataclass
class Header:
    schema_json: str
    codec: str
    sync: bytes
    size: int


def read_header(stream) -> Header:
    if stream.read(4) != MAGIC:
        raise ValueError("not an Avro container file")
    meta, size = {}, 4
    while count := _stream_long(stream):
        if count < 0:
            _stream_long(stream)
        for _ in range(abs(count)):
            key = stream.read(_stream_long(stream)).decode()
            meta[key] = stream.read(_stream_long(stream))
    sync = stream.read(SYNC_SIZE)
    try:
        size = stream.tell()
    except (OSError, io.UnsupportedOperation):
        size = -1
    return Header(meta["avro.schema"].decode(), meta.get("avro.codec", b"null").decode(), sync, size)


def file_schema(path: str) -> str:
    with _open(path) as stream:
        return read_header(stream).schema_json


def _snappy_inflate(payload: bytes) -> bytes:
    # a raw block starts with its size; a checksum of the content follows it
    body, size = payload[:-4], _stream_long_raw(payload)
    content = pa.Codec("snappy").decompress(body, decompressed_size=size, asbytes=True) if size else b""
    if zlib.crc32(content) != int.from_bytes(payload[-4:], "big"):
        raise ValueError("snappy block fails its checksum")
    return content


def _stream_long_raw(payload: bytes) -> int:
    """A leading variable-length number, not zig-zag coded."""
    value = 0
    for k, byte in enumerate(payload):
        value |= (byte & 0x7F) << (7 * k)
        if byte < 0x80:
            return value
    raise ValueError("block is cut short")


def _snappy_deflate(content: bytes) -> bytes:
    return pa.Codec("snappy").compress(content, asbytes=True) + zlib.crc32(content).to_bytes(4, "big")


def _zstd_inflate(payload: bytes) -> bytes:
    return pa.input_stream(pa.BufferReader(payload), compression="zstd").read()


# Codec name of the container format: unpack and pack a block.
CODECS = {
    "null": (bytes, bytes),
    "deflate": (lambda b: zlib.decompress(b, -15), lambda b: zlib.compress(b, wbits=-15)),
    "snappy": (_snappy_inflate, _snappy_deflate),
    "bzip2": (bz2.decompress, bz2.compress),
    "xz": (lzma.decompress, lzma.compress),
    "zstandard": (_zstd_inflate, lambda b: pa.Codec("zstd").compress(b, asbytes=True)),
}


def _inflate(payload: bytes, codec: str) -> bytes:
    if codec not in CODECS:
        raise NotImplementedError(f"Avro codec {codec!r}")
    return CODECS[codec][0](payload)


def _seek_sync(stream, position: int, sync: bytes) -> int | None:
    """Move just past the first sync marker at or after ``position``."""
    stream.seek(position)
    window, base = b"", position
    while chunk := stream.read(1 << 20):
        window += chunk
        at = window.find(sync)
        if at >= 0:
            stream.seek(base + at + SYNC_SIZE)
            return base + at + SYNC_SIZE
        base += max(0, len(window) - SYNC_SIZE + 1)
        window = window[-(SYNC_SIZE - 1):]
    return None


def read_blocks(chunk: Chunk) -> Iterator[tuple[str, int, bytes]]:
    """(schema, record count, records) of the blocks that belong to a chunk: those
    whose preceding sync marker starts inside it."""
    with _open(chunk.path) as stream:
        header = read_header(stream)
        cuttable = not chunk.path.endswith(GZIP_SUFFIX)
        position = header.size
        if cuttable and chunk.start > header.size - SYNC_SIZE:
            position = _seek_sync(stream, chunk.start, header.sync)
            if position is None:
                return
        while not cuttable or position - SYNC_SIZE < chunk.end:
            count = _stream_long(stream)
            if count is None:
                return
            payload = stream.read(_stream_long(stream))
            if stream.read(SYNC_SIZE) != header.sync:
                raise ValueError(f"{chunk.path}: sync marker mismatch")
            yield header.schema_json, count, _inflate(payload, header.codec)
            if cuttable:
                position = stream.tell()


def _encode_header(schema_json: str, codec: str, sync: bytes) -> bytes:
    def text(value: bytes) -> bytes:
        return avro_codec.encode_long(np.array([len(value)]))[0].as_py() + value

    pairs = text(b"avro.schema") + text(schema_json.encode()) + text(b"avro.codec") + text(codec.encode())
    return MAGIC + b"\x04" + pairs + b"\x00" + sync


# -- data source --------------------------------------------------------------
class AlertAvroSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "alert_avro"

    def _path(self) -> str | list[str]:
        if "paths" in self.options:
            return json.loads(self.options["paths"])
        return self.options["path"]

    def _max_files(self) -> int | None:
        return int(self.options["maxFiles"]) if "maxFiles" in self.options else None

    def schema(self) -> T.StructType:
        logical = self.options.get("logicalTypes", "false").lower() == "true"
        if "avroSchema" in self.options:
            given = json.loads(self.options["avroSchema"])
            versions = given if isinstance(given, list) else [given]
        else:
            files = list_files(self._path(), self._max_files())
            if not files:
                raise IOError(f"no Avro file in {self._path()}")
            with ThreadPoolExecutor(16) as pool:
                versions = list(dict.fromkeys(pool.map(file_schema, [f for f, _ in files])))
        struct = avro_schema.superset(versions, logical)
        columns = self.options.get("columns")
        return avro_schema.prune(struct, columns.split(",") if columns else None)

    def reader(self, schema: T.StructType) -> "AlertAvroReader":
        limit = int(self.options.get("maxPartitionBytes", MAX_PARTITION_BYTES))
        return AlertAvroReader(self._path(), self._max_files(), limit, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> "AlertAvroWriter":
        given = self.options.get("avroSchema")
        avro = avro_schema.parse(given) if given else avro_schema.struct_type_to_avro(schema)
        return AlertAvroWriter(self.options["path"], avro, self.options.get("compression", "null"), overwrite)


class AlertAvroReader(DataSourceReader):
    def __init__(self, path, max_files, max_bytes, schema):
        self.path, self.max_files, self.max_bytes, self.struct = path, max_files, max_bytes, schema

    def partitions(self):
        chunks = []
        for path, size in list_files(self.path, self.max_files):
            _check_suffix(path)
            step = size if path.endswith(GZIP_SUFFIX) else self.max_bytes
            chunks += [Chunk(path, at, min(at + step, size)) for at in range(0, max(size, 1), max(step, 1))]
        packed, current, weight = [], [], 0
        for chunk in chunks:
            cost = chunk.end - chunk.start + min(OPEN_COST_BYTES, self.max_bytes // 32)
            if current and weight + cost > self.max_bytes:
                packed.append(ChunkPartition(current))
                current, weight = [], 0
            current.append(chunk)
            weight += cost
        if current:
            packed.append(ChunkPartition(current))
        return packed

    def read(self, partition: ChunkPartition):
        target = pa.struct(list(to_arrow_schema(self.struct)))
        parsed: dict[str, dict] = {}
        pending: list[tuple[str, int, bytes]] = []
        held = 0

        def flush():
            by_schema: dict[str, list] = {}
            for schema_json, count, payload in pending:
                by_schema.setdefault(schema_json, []).append((count, payload))
            for schema_json, blocks in by_schema.items():
                if schema_json not in parsed:
                    parsed[schema_json] = avro_schema.parse(schema_json)
                rows = avro_codec.decode_blocks(
                    [p for _, p in blocks], [c for c, _ in blocks], parsed[schema_json], target
                )
                for at in range(0, len(rows), 4096):
                    yield pa.RecordBatch.from_struct_array(rows.slice(at, 4096))

        for chunk in partition.chunks:
            for block in read_blocks(chunk):
                pending.append(block)
                held += len(block[2])
                if held >= FLUSH_BYTES:
                    yield from flush()
                    pending, held = [], 0
        yield from flush()


@dataclass
class FileWritten(WriterCommitMessage):
    path: str


class AlertAvroWriter(DataSourceArrowWriter):
    def __init__(self, path, schema, codec, overwrite):
        if codec not in CODECS:
            raise ValueError(f"cannot write Avro codec {codec!r}")
        self.path, self.schema, self.codec, self.overwrite = path, schema, codec, overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator):
        name, sync = f"part-{uuid.uuid4().hex}{PLAIN_SUFFIX}", os.urandom(SYNC_SIZE)
        filesystem, inner = open_filesystem(self.path)
        out = None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                filesystem.create_dir(posixpath.join(inner, self.staging))
                out = filesystem.open_output_stream(posixpath.join(inner, self.staging, name))
                out.write(_encode_header(json.dumps(self.schema), self.codec, sync))
            for block in self._blocks(avro_codec.encode(self.schema, batch.to_struct_array()), sync):
                out.write(block)
        if out is None:
            return FileWritten("")
        out.close()
        return FileWritten(name)

    def _blocks(self, bodies, sync):
        offsets = np.frombuffer(bodies.buffers()[1], dtype=np.int32)[bodies.offset : bodies.offset + len(bodies) + 1]
        data = memoryview(bodies.buffers()[2])
        first = 0
        while first < len(bodies):
            stop = int(np.searchsorted(offsets, offsets[first] + WRITE_BLOCK_BYTES, side="left"))
            last = min(max(stop, first + 1), len(bodies))
            payload = bytes(data[offsets[first] : offsets[last]])
            payload = CODECS[self.codec][1](payload)
            counts = avro_codec.encode_long(np.array([last - first, len(payload)]))
            yield counts[0].as_py() + counts[1].as_py() + payload + sync
            first = last

    def commit(self, messages):
        filesystem, inner = open_filesystem(self.path)
        filesystem.create_dir(inner)
        if self.overwrite:
            for old, _ in list_files(self.path, nested=False):
                filesystem.delete_file(open_filesystem(old)[1])
        for message in messages:
            if message is not None and message.path:
                filesystem.move(posixpath.join(inner, self.staging, message.path), posixpath.join(inner, message.path))
        self.abort(messages)

    def abort(self, messages):
        filesystem, inner = open_filesystem(self.path)
        staging = posixpath.join(inner, self.staging)
        if filesystem.get_file_info(staging).type == pafs.FileType.Directory:
            filesystem.delete_dir(staging)


# -- user entry points --------------------------------------------------------
def register(spark: SparkSession) -> None:
    spark.dataSource.register(AlertAvroSource)


_HEADERS = "path string, size bigint, schema_json string"


def distinct_file_schemas(spark: SparkSession, files: list[tuple[str, int]], manifest: str | None = None) -> list[str]:
    """Writer schemas of many files (path and size), their headers read by a Spark job.

    Only the distinct schema texts come back, in the order of the first file in
    the list that carries each. A ``manifest`` is a table of the headers read so
    far: files it has, by path and size, are not opened, and the others are added.
    """

    def headers(batches):
        for batch in batches:
            schemas = pa.array([file_schema(p) for p in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), schemas], ["path", "size", "schema_json"])

    paths, sizes = [f for f, _ in files], [n for _, n in files]
    listing = spark.createDataFrame(
        pa.table([pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(range(len(files)), pa.int64())], ["path", "size", "place"])
    )
    width = max(1, min(len(files) // 16, 4 * spark.sparkContext.defaultParallelism))
    known = read_table_if_exists(spark, manifest, T.StructType.fromDDL(_HEADERS)) if manifest else None
    new = listing if known is None else listing.join(known, ["path", "size"], "left_anti")
    read = new.select("path", "size").repartition(width).mapInArrow(headers, _HEADERS)
    if manifest:
        if not new.isEmpty():
            read.write.mode("append").parquet(manifest)
        read = spark.read.schema(_HEADERS).parquet(manifest)
    found = listing.join(read, ["path", "size"])
    rows = found.groupBy("schema_json").agg(F.min("place").alias("place")).orderBy("place").collect()
    return [r.schema_json for r in rows]


def read_alerts(
    spark: SparkSession,
    path: str | list[str],
    size: int | None = None,
    columns: list[str] | None = None,
    avro_schemas: list[str] | None = None,
    logical_types: bool = False,
    manifest: str | None = None,
) -> DataFrame:
    """Alerts of a file, a list of files or a folder, versions merged by name.

    Headers are read by a job, only of files that the table ``manifest`` lacks, if it is given.
    ``size`` keeps the first ``size`` files and then the first ``size`` records of them.
    """
    register(spark)
    if not path:
        warnings.warn("empty path: no alert to read")
        return spark.createDataFrame([], T.StructType([]))
    path = [qualified(spark, p) for p in path] if isinstance(path, list) else qualified(spark, path)
    files = list_files(path, size)
    for name, _ in files:
        _check_suffix(name)
    if avro_schemas is None:
        avro_schemas = distinct_file_schemas(spark, files, qualified(spark, manifest) if manifest else None)
    reader = (
        spark.read.format("alert_avro")
        .option("avroSchema", json.dumps([avro_schema.parse(s) for s in avro_schemas]))
        .option("logicalTypes", str(logical_types).lower())
    )
    # As Spark does for its own file formats: full-size partitions for large
    # inputs, enough of them to use every core for small ones.
    share = sum(n for _, n in files) // spark.sparkContext.defaultParallelism
    reader = reader.option("maxPartitionBytes", str(min(MAX_PARTITION_BYTES, max(MIN_PARTITION_BYTES, share))))
    if isinstance(path, list):
        reader = reader.option("paths", json.dumps(path))
    if columns:
        reader = reader.option("columns", ",".join(columns))
    if size is not None:
        reader = reader.option("maxFiles", str(size))
    df = reader.load() if isinstance(path, list) else reader.load(path)
    if size is None:
        return df
    # Files are read in order, and so are their records: the id says which come first.
    return df.withColumn("_at", F.monotonically_increasing_id()).orderBy("_at").limit(size).drop("_at")


def write_avro(
    df: DataFrame,
    path: str,
    schema: str | dict | None = None,
    mode: str = "errorifexists",
    compression: str = "null",
) -> None:
    """Write container files, one per task; an existing target is an error
    unless ``mode`` is ``overwrite`` or ``append``."""
    register(df.sparkSession)
    if mode not in ("errorifexists", "overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    path = qualified(df.sparkSession, path)
    filesystem, inner = open_filesystem(path)
    exists = filesystem.get_file_info(inner).type == pafs.FileType.Directory
    if mode == "errorifexists" and exists and list_files(path, nested=False):
        raise IOError(f"{path} already exists")
    writer = df.write.format("alert_avro").option("compression", compression)
    if schema is not None:
        writer = writer.option("avroSchema", json.dumps(avro_schema.parse(schema)))
    writer.mode("overwrite" if mode == "overwrite" else "append").save(path)
