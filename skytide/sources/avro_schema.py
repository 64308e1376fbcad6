"""Avro schemas as Spark schemas, and by-name union of schema versions."""

from __future__ import annotations

import json
import re

from pyspark.sql import types as T

PRIMITIVES = {
    "null": T.StringType(),  # Parquet has no void column; always null
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}
AVRO_NAMES = {
    T.BooleanType: "boolean",
    T.IntegerType: "int",
    T.LongType: "long",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.BinaryType: "bytes",
    T.StringType: "string",
}
_WIDENING = [T.IntegerType, T.LongType, T.FloatType, T.DoubleType]
LEGACY_SUFFIX = "_legacy"


def parse(schema: str | dict) -> dict:
    parsed = json.loads(schema) if isinstance(schema, str) else schema
    if not isinstance(parsed, dict) or parsed.get("type") != "record":
        raise ValueError("the root of an alert schema must be a record")
    return parsed


def to_spark_type(avro_type, logical_types: bool = False) -> T.DataType:
    """Spark type of an Avro type; a union gives its first non-null branch.

    Enum, fixed, references to named types and logical types are refused;
    ``logical_types=True`` lets timestamps through.
    """
    if isinstance(avro_type, list):
        branches = [b for b in avro_type if b != "null"]
        return to_spark_type(branches[0] if branches else "null", logical_types)
    if isinstance(avro_type, str):
        if avro_type not in PRIMITIVES:
            raise ValueError(f"unsupported Avro type {avro_type!r}")
        return PRIMITIVES[avro_type]
    kind = avro_type.get("type")
    if kind == "record":
        return T.StructType(
            [T.StructField(f["name"], to_spark_type(f["type"], logical_types)) for f in avro_type["fields"]]
        )
    if kind == "array":
        return T.ArrayType(to_spark_type(avro_type["items"], logical_types))
    if kind == "map":
        return T.MapType(T.StringType(), to_spark_type(avro_type["values"], logical_types))
    if logical_types and avro_type.get("logicalType") in ("timestamp-micros", "timestamp-millis"):
        return T.TimestampType()
    raise ValueError(f"unsupported Avro type {json.dumps(avro_type)}")


def avro_to_struct_type(schema: str | dict, logical_types: bool = False) -> T.StructType:
    return to_spark_type(parse(schema), logical_types)


def struct_type_to_avro(struct: T.StructType, name: str = "alert") -> dict:
    """An Avro schema for a Spark schema; nullable fields become ``[T, "null"]``."""

    def convert(data_type, path):
        if isinstance(data_type, T.StructType):
            fields = [{"name": f.name, "type": field_type(f, f"{path}_{f.name}")} for f in data_type.fields]
            return {"type": "record", "name": path, "fields": fields}
        if isinstance(data_type, T.ArrayType):
            items = convert(data_type.elementType, f"{path}_item")
            return {"type": "array", "items": [items, "null"] if data_type.containsNull else items}
        if isinstance(data_type, T.MapType):
            values = convert(data_type.valueType, f"{path}_value")
            return {"type": "map", "values": [values, "null"] if data_type.valueContainsNull else values}
        if isinstance(data_type, T.TimestampType):
            return {"type": "long", "logicalType": "timestamp-micros"}
        if type(data_type) not in AVRO_NAMES:
            raise ValueError(f"no Avro type for {data_type.simpleString()}")
        return AVRO_NAMES[type(data_type)]

    def field_type(field, path):
        inner = convert(field.dataType, path)
        return [inner, "null"] if field.nullable else inner

    return convert(struct, name)


def merge_types(newer: T.DataType, older: T.DataType) -> T.DataType | None:
    """Common type of one field in two versions, or None when there is none."""
    if isinstance(newer, T.StructType) and isinstance(older, T.StructType):
        return merge_structs(newer, older)
    if isinstance(newer, T.ArrayType) and isinstance(older, T.ArrayType):
        inner = merge_types(newer.elementType, older.elementType)
        return T.ArrayType(inner) if inner is not None else None
    if isinstance(newer, T.MapType) and isinstance(older, T.MapType):
        inner = merge_types(newer.valueType, older.valueType)
        return T.MapType(T.StringType(), inner) if inner is not None else None
    if type(newer) is type(older):
        return newer
    if type(newer) in _WIDENING and type(older) in _WIDENING:
        pair = {type(newer), type(older)}
        if pair in ({T.LongType, T.FloatType}, {T.IntegerType, T.FloatType}):
            return T.DoubleType()
        return max(newer, older, key=lambda t: _WIDENING.index(type(t)))
    return None


def merge_structs(newer: T.StructType, older: T.StructType) -> T.StructType:
    """By-name union. A field whose type changed keeps the newer type; the older
    one is kept beside it as ``<name>_legacy``."""
    fields = {f.name: f.dataType for f in newer.fields}
    for f in older.fields:
        if f.name not in fields:
            fields[f.name] = f.dataType
            continue
        merged = merge_types(fields[f.name], f.dataType)
        if merged is not None:
            fields[f.name] = merged
        else:
            legacy = f.name + LEGACY_SUFFIX
            kept = merge_types(fields[legacy], f.dataType) if legacy in fields else f.dataType
            if kept is None:
                raise ValueError(f"field {f.name!r} has more than two incompatible types")
            fields[legacy] = kept
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def version_order(version: str) -> list:
    """Sort key that puts 3.9.0 before 3.10.1."""
    return [(0, int(part), "") if part.isdigit() else (1, 0, part) for part in re.split(r"(\d+)", version) if part]


def superset(schemas: list[str | dict], logical_types: bool = False) -> T.StructType:
    """Union of schema versions given oldest first; newer types win."""
    merged: T.StructType | None = None
    for schema in reversed(schemas):
        struct = avro_to_struct_type(schema, logical_types)
        merged = struct if merged is None else merge_structs(merged, struct)
    if merged is None:
        raise ValueError("no schema given")
    return merged


def prune(struct: T.StructType, columns: list[str] | None) -> T.StructType:
    """Keep the given fields only; ``a.b`` keeps one field of a struct or of an
    array of structs. Fields left out are skipped over while decoding."""
    if columns is None:
        return struct
    wanted: dict[str, list[str] | None] = {}
    for name in columns:
        head, _, tail = name.partition(".")
        if not tail:
            wanted[head] = None
        elif wanted.get(head, []) is not None:
            wanted.setdefault(head, []).append(tail)
    unknown = [n for n in wanted if n not in struct.fieldNames()]
    if unknown:
        raise ValueError(f"unknown fields {unknown}")

    def narrow(data_type, tails):
        if tails is None:
            return data_type
        if isinstance(data_type, T.ArrayType):
            return T.ArrayType(narrow(data_type.elementType, tails))
        if not isinstance(data_type, T.StructType):
            raise ValueError(f"{tails} name fields of a {data_type.simpleString()}")
        return prune(data_type, tails)

    return T.StructType(
        [T.StructField(f.name, narrow(f.dataType, wanted[f.name])) for f in struct.fields if f.name in wanted]
    )
