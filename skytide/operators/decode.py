"""Schema resolution per message, bulk decoding and encoding of alert bodies."""

from __future__ import annotations

import json
import posixpath
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skytide.naming import DEFAULT_NAMING, REPLAYED_SUFFIX, SCHEMA_TOPIC_SUFFIX, Naming
from skytide.session import open_filesystem, qualified
from skytide.sources import avro_codec, avro_schema

MODES = ("FAILFAST", "PERMISSIVE")
OVERRIDE_ID = "override"
# Up to so many known ids keep the keys' schema texts out of the tasks.
_MAX_KNOWN_FILTER = 200
LOG_COLUMNS = ["topic", "partition", "offset", "timestamp"]


class UnknownSchemaError(ValueError):
    """A message names a schema the registry does not hold."""


# -- which schema -------------------------------------------------------------
def key_is_schema(key: Column) -> Column:
    """A schema key is a JSON object; a version string never starts with a brace."""
    return F.coalesce(F.ltrim(key).startswith("{"), F.lit(False))


def schema_id(key: Column) -> Column:
    return F.when(key_is_schema(key), F.sha2(key, 256)).otherwise(F.coalesce(key, F.lit("")))


def resolve_schemas(raw: DataFrame, override: str | None = None) -> DataFrame:
    """Add ``schema_id``: the key's own schema, else the override, else the version."""
    key = F.col("key").cast("string")
    otherwise = F.lit(OVERRIDE_ID) if override is not None else F.coalesce(key, F.lit(""))
    return raw.withColumn("schema_id", F.when(key_is_schema(key), F.sha2(key, 256)).otherwise(otherwise))


def schema_table(raw: DataFrame, logical_types: bool = False) -> DataFrame:
    """The distinct schemas seen in message keys, one row per topic and schema."""

    @F.udf("string")
    def spark_schema(text):
        return avro_schema.avro_to_struct_type(text, logical_types).json()

    key = F.col("key").cast("string")
    # Distinct on the text itself combines map-side; the hash and the Spark form
    # are then worked out once per schema.
    seen = raw.filter(key_is_schema(key)).select("topic", key.alias("schema_json")).distinct()
    return seen.select(
        "topic",
        F.sha2("schema_json", 256).alias("schema_id"),
        "schema_json",
        spark_schema("schema_json").alias("spark_schema_json"),
    )


def topic_schema(raw: DataFrame, topic: str) -> str:
    """Schema of a bulk topic: key of the first message on its schema topic."""
    first = (
        raw.filter(F.col("topic") == topic + SCHEMA_TOPIC_SUFFIX)
        .orderBy("partition", "offset")
        .select(F.col("key").cast("string").alias("key"))
        .limit(1)
        .collect()
    )
    if not first or first[0].key is None:
        raise LookupError(f"no schema published for topic {topic!r}")
    return first[0].key


def load_registry(table: DataFrame) -> dict[str, str]:
    """A registry table (``schema_id``, ``schema_json``) as a lookup for tasks."""
    rows = table.select("schema_id", "schema_json").distinct().collect()
    return {r.schema_id: r.schema_json for r in rows}


def registry_from_folder(
    spark: SparkSession, folder: str, naming: Naming = DEFAULT_NAMING, survey: str = "ztf"
) -> DataFrame:
    """Registry table of a folder of schema files named after their version."""
    head, tail = naming.schema_file("*", survey).split("*")
    filesystem, inner = open_filesystem(qualified(spark, folder))
    rows = []
    for info in filesystem.get_file_info(pafs.FileSelector(inner)):
        name = posixpath.basename(info.path)
        if info.is_file and name.startswith(head) and name.endswith(tail):
            with filesystem.open_input_stream(info.path) as stream:
                rows.append((name[len(head) : len(name) - len(tail)], stream.readall().decode()))
    return spark.createDataFrame(sorted(rows), "schema_id string, schema_json string")


# -- decode -------------------------------------------------------------------
def fields_outside(writer: T.StructType, target: T.StructType, path: str = "") -> list[str]:
    """Names of a writer's fields, dotted when nested, that ``target`` has no place for."""
    out = []
    for field in writer.fields:
        name = path + field.name
        if field.name not in target.fieldNames():
            out.append(name)
            continue
        inner, place = field.dataType, target[field.name].dataType
        while isinstance(inner, T.ArrayType) and isinstance(place, T.ArrayType):
            inner, place = inner.elementType, place.elementType
        if isinstance(inner, T.StructType) and isinstance(place, T.StructType):
            out += fields_outside(inner, place, name + ".")
    return out


# What a schema text or a body that no reader can use may raise.
_UNUSABLE = (ValueError, KeyError, TypeError, AttributeError, IndexError, NotImplementedError, RecursionError, pa.ArrowException)


def _decode_batches(batches, target, full, shared, keep, mode, output):
    registry = shared.value
    parsed: dict[str, tuple[dict | None, str | None, list[str] | None]] = {}

    def read(text):
        """Schema, error, fields outside the target, of a schema's text."""
        try:
            schema = avro_schema.parse(text)
            if not isinstance(schema, dict) or schema.get("type") != "record":
                return None, "not a record schema", None
            return schema, None, fields_outside(avro_schema.avro_to_struct_type(schema), full) or None
        except _UNUSABLE as err:
            return None, f"unusable schema: {type(err).__name__}: {err}"[:300], None

    def lookup(ident, key):
        if ident not in parsed:
            text = registry.get(ident, key)
            found = (None, f"unknown schema {ident!r}", None) if text is None else read(text)
            if found[0] is None and text is not None and ident not in registry and OVERRIDE_ID in registry:
                found = read(registry[OVERRIDE_ID])  # a key that is no schema: as if there were none
            parsed[ident] = found
        return parsed[ident]

    def decode(bodies, schema):
        try:
            return (*avro_codec.decode_bodies(bodies, schema, target), None)
        except _UNUSABLE as err:
            return None, None, f"cannot read with this schema: {type(err).__name__}: {err}"[:300]

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        value = batch.column("value")
        ids = batch.column("schema_id").dictionary_encode()
        codes = ids.indices.to_numpy()
        parts, order = [], []
        errors = np.full(n, None, dtype=object)
        dropped = np.full(n, None, dtype=object)
        replayed = np.zeros(n, dtype=bool)
        for code, ident in enumerate(ids.dictionary.to_pylist()):
            rows = np.flatnonzero(codes == code)
            schema, problem, outside = lookup(ident, batch.column("_schema_text")[int(rows[0])].as_py())
            bodies = value if len(rows) == n else value.take(pa.array(rows))
            if schema is not None:
                decoded, status, problem = decode(bodies, schema)
            if problem is not None:
                errors[rows] = problem
                parts.append(pa.nulls(len(rows), target))
                order.append(rows)
                continue
            if outside:
                for i in rows:
                    dropped[i] = outside
            bad = np.flatnonzero(status)
            twin = lookup(ident + REPLAYED_SUFFIX, None)[0] if bad.size and ident + REPLAYED_SUFFIX in registry else None
            again, second, failed = decode(bodies.take(pa.array(bad)), twin) if twin is not None else (None, None, "none")
            if failed is None:
                # Same fields in another order: only worth a try once the first
                # schema has failed, and the retry is reported.
                cured = np.flatnonzero(second == avro_codec.OK)
                source = np.arange(len(rows))
                source[bad[cured]] = len(rows) + cured
                decoded = pa.concat_arrays([decoded, again]).take(pa.array(source))
                replayed[rows[bad[cured]]] = True
                status[bad[cured]] = avro_codec.OK
            bad = np.flatnonzero(status)
            if bad.size:
                for i in bad:
                    errors[rows[i]] = avro_codec.ERRORS[int(status[i])]
                gone = np.zeros(len(rows), dtype=bool)
                gone[bad] = True
                decoded = decoded.take(pa.array(np.arange(len(rows)), mask=gone))
            parts.append(decoded)
            order.append(rows)
        missing = np.flatnonzero(errors != None)  # noqa: E711  elementwise on objects
        if missing.size and mode == "FAILFAST":
            i = int(missing[0])
            where = {c: batch.column(c)[i].as_py() for c in ("topic", "partition", "offset") if c in keep}
            raise ValueError(f"cannot decode message {where}, schema {ids[i].as_py()!r}: {errors[i]}")
        alert = parts[0]
        if len(parts) > 1:
            alert = pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(order), kind="stable")))
        columns = [batch.column(c) for c in keep] + [
            batch.column("schema_id"),
            alert,
            pa.array(replayed),
            pa.array(errors, pa.string()),
            pa.array(dropped, pa.list_(pa.string())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=output)


def decode_alerts(
    raw: DataFrame,
    target: T.StructType,
    registry: dict[str, str] | None = None,
    override: str | dict | None = None,
    columns: list[str] | None = None,
    mode: str = "FAILFAST",
    keep: list[str] | None = None,
) -> DataFrame:
    """Decode every message of a topic log in one pass, whatever its schema.

    ``target`` is the superset schema of the result; fields a writer lacks are
    null and fields outside ``columns`` are skipped, not built. The result has
    the kept log columns, ``schema_id``, ``alert``, ``replayed`` (decoded with
    the reordered twin of its schema), ``error`` and ``dropped_fields``, the
    fields of the writer's schema for which ``target`` has no place (null if
    none; fields left out by ``columns`` are a choice and not listed).
    ``FAILFAST`` raises on the first bad message, ``PERMISSIVE`` gives it a null
    alert and an error, also when its key is no usable schema. The registry goes
    to the tasks once, as a Spark broadcast.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(MODES)}")
    known = dict(registry or {})
    if override is not None:
        known[OVERRIDE_ID] = override if isinstance(override, str) else json.dumps(override)
    keep = [c for c in LOG_COLUMNS if c in raw.columns] if keep is None else keep
    full, target = target, avro_schema.prune(target, columns)
    resolved = resolve_schemas(raw, known.get(OVERRIDE_ID))
    key = F.col("key").cast("string")
    # The schema text goes to Python only when the registry lacks it.
    unknown = key_is_schema(key)
    if known and len(known) <= _MAX_KNOWN_FILTER:
        unknown = unknown & ~F.col("schema_id").isin(*known)
    slim = resolved.select(*keep, "schema_id", "value", F.when(unknown, key).alias("_schema_text"))
    schema = T.StructType(
        [resolved.schema[c] for c in keep]
        + [
            T.StructField("schema_id", T.StringType()),
            T.StructField("alert", target),
            T.StructField("replayed", T.BooleanType()),
            T.StructField("error", T.StringType()),
            T.StructField("dropped_fields", T.ArrayType(T.StringType())),
        ]
    )
    run = partial(
        _decode_batches,
        target=pa.struct(list(to_arrow_schema(target))),
        full=full,
        shared=raw.sparkSession.sparkContext.broadcast(known),
        keep=keep,
        mode=mode,
        output=schema.fieldNames(),
    )
    return slim.mapInArrow(run, schema)


# -- encode -------------------------------------------------------------------
def encode_alerts(df: DataFrame, schema: str | dict, fields: list[str] | None = None, name: str = "value") -> DataFrame:
    """Add the schemaless Avro body of each row; other columns stay in the JVM."""
    avro = avro_schema.parse(schema)
    wanted = fields or [f["name"] for f in avro["fields"] if f["name"] in df.columns]

    @F.arrow_udf(T.BinaryType())
    def body(record: pa.Array) -> pa.Array:
        return avro_codec.encode(avro, record)

    return df.withColumn(name, body(F.struct(*[F.col(c) for c in wanted])))
