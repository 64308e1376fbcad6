import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import alerts
from skytide.sources import avro_codec as codec
from skytide.sources import avro_schema as schemas


def arrow_type(schema, logical=False):
    return pa.struct(list(to_arrow_schema(schemas.avro_to_struct_type(schema, logical))))


def record(*fields):
    return {"type": "record", "name": "r", "fields": [{"name": n, "type": t} for n, t in fields]}


def reference_encode(t, v):
    """Plain, slow encoder straight from the Avro specification."""
    if isinstance(t, list):
        i = t.index("null") if v is None else next(k for k, b in enumerate(t) if b != "null")
        return reference_encode("long", i) + (b"" if v is None else reference_encode(t[i], v))
    kind = t if isinstance(t, str) else t["type"]
    if kind == "record":
        return b"".join(reference_encode(f["type"], v[f["name"]]) for f in t["fields"])
    if kind == "array":
        body = b"".join(reference_encode(t["items"], x) for x in v)
        return (reference_encode("long", len(v)) + body if v else b"") + b"\0"
    if kind == "map":
        body = b"".join(reference_encode("string", k) + reference_encode(t["values"], x) for k, x in v)
        return (reference_encode("long", len(v)) + body if v else b"") + b"\0"
    if kind in ("int", "long"):
        n, out = (v << 1) ^ (v >> 63), b""
        while True:
            if n < 128:
                return out + bytes([n])
            out += bytes([n & 127 | 128])
            n >>= 7
    if kind in ("string", "bytes"):
        raw = v.encode() if kind == "string" else v
        return reference_encode("long", len(raw)) + raw
    return {"double": lambda: struct.pack("<d", v), "float": lambda: struct.pack("<f", v),
            "boolean": lambda: bytes([v]), "null": lambda: b""}[kind]()


def test_full_alert_round_trip_and_bytes():
    schema = alerts.ztf_schema()
    rows = alerts.rows(schema, 60)
    typed = pa.array(rows, arrow_type(schema))
    bodies = codec.encode(schema, typed)
    assert bodies.to_pylist() == [reference_encode(schema, r) for r in rows]
    decoded, status = codec.decode_bodies(bodies, schema, typed.type)
    assert not status.any() and decoded.equals(typed)
    # A slice of a batch has offsets of its own.
    part, status = codec.decode_bodies(bodies.slice(11, 20), schema, typed.type)
    assert not status.any() and part.equals(typed.slice(11, 20))
    assert codec.encode(schema, typed.slice(11, 20)).equals(bodies.slice(11, 20))


_leaf = st.sampled_from(["boolean", "int", "long", "float", "double", "bytes", "string"])


def _wrap(inner):
    return st.one_of(
        inner.filter(lambda t: not isinstance(t, list)).map(lambda t: [t, "null"]),
        inner.filter(lambda t: not isinstance(t, list)).map(lambda t: ["null", t]),
        inner.map(lambda t: {"type": "array", "items": t}),
        inner.map(lambda t: {"type": "map", "values": t}),
        st.lists(inner, min_size=1, max_size=3).map(lambda ts: record(*[(f"f{i}", t) for i, t in enumerate(ts)])),
    )


@settings(max_examples=80, deadline=None)
@given(st.lists(st.recursive(_leaf, _wrap, max_leaves=6), min_size=1, max_size=4), st.integers(0, 10**6))
def test_any_schema_round_trips(types, seed):
    schema = record(*[(f"c{i}", t) for i, t in enumerate(types)])
    typed = pa.array(alerts.rows(schema, 17, seed), arrow_type(schema))
    bodies = codec.encode(schema, typed)
    assert bodies.to_pylist() == [reference_encode(schema, r) for r in alerts.rows(schema, 17, seed)]
    decoded, status = codec.decode_bodies(bodies, schema, typed.type)
    assert not status.any()
    assert decoded.to_pylist() == typed.to_pylist()


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=80), st.integers(0, 40))
def test_garbage_only_harms_its_own_row(noise, cut):
    schema = alerts.ztf_schema()
    typed = pa.array(alerts.rows(schema, 3), arrow_type(schema))
    good = codec.encode(schema, typed).to_pylist()
    bodies = pa.array([good[0], noise, good[1][:cut], good[2], good[1] + b"\0"], pa.binary())
    decoded, status = codec.decode_bodies(bodies, schema, typed.type)
    assert status.tolist()[0] == status.tolist()[3] == codec.OK
    assert status[1] != codec.OK and status[2] != codec.OK and status[4] == codec.TRAILING
    assert decoded[0] == typed[0] and decoded[3] == typed[2]


def test_pruned_fields_are_skipped_not_read():
    schema = alerts.ztf_schema()
    full = schemas.avro_to_struct_type(schema)
    narrow = schemas.prune(full, ["objectId", "candidate.jd", "prv_candidates.fid", "prv_candidates.jd"])
    assert narrow.simpleString() == (
        "struct<objectId:string,candidate:struct<jd:double>,prv_candidates:array<struct<jd:double,fid:int>>>"
    )
    rows = alerts.rows(schema, 30)
    bodies = codec.encode(schema, pa.array(rows, arrow_type(schema)))
    decoded, status = codec.decode_bodies(bodies, schema, pa.struct(list(to_arrow_schema(narrow))))
    assert not status.any()
    got = decoded.to_pylist()
    assert [g["objectId"] for g in got] == [r["objectId"] for r in rows]
    past = [None if r["prv_candidates"] is None else [p and {"jd": p["jd"], "fid": p["fid"]} for p in r["prv_candidates"]] for r in rows]
    assert [g["prv_candidates"] for g in got] == past
    with pytest.raises(ValueError):
        schemas.prune(full, ["nothing"])


def test_negative_block_counts_and_several_blocks():
    schema = record(("a", {"type": "array", "items": "int"}))
    # Blocks of 2 (with byte size) and 1 items, then the end.
    body = reference_encode("long", -2) + reference_encode("long", 2) + b"\x02\x04" + b"\x02\x06" + b"\0"
    decoded, status = codec.decode_bodies(pa.array([body, b"\0", None], pa.binary()), schema, arrow_type(schema))
    assert decoded[0].as_py() == {"a": [1, 2, 3]} and decoded[1].as_py() == {"a": []}
    assert status.tolist() == [codec.OK, codec.OK, codec.CORRUPT]


def test_declared_union_order_is_followed():
    null_last, null_first = record(("x", ["int", "null"])), record(("x", ["null", "int"]))
    target = arrow_type(null_last)
    assert codec.decode_bodies(pa.array([b"\x00\x0a", b"\x02"], pa.binary()), null_last, target)[0].to_pylist() == [{"x": 5}, {"x": None}]
    assert codec.decode_bodies(pa.array([b"\x02\x0a", b"\x00"], pa.binary()), null_first, target)[0].to_pylist() == [{"x": 5}, {"x": None}]


def test_wide_union_takes_the_first_type():
    schema = record(("x", ["long", "string", "null", "int"]))
    assert schemas.avro_to_struct_type(schema).simpleString() == "struct<x:bigint>"
    bodies = pa.array([b"\x00\x0a", b"\x04", b"\x06\x0c", b"\x02\x02z"], pa.binary())
    decoded, status = codec.decode_bodies(bodies, schema, arrow_type(schema))
    assert [d["x"] for d in decoded.to_pylist()][:3] == [5, None, 6]
    assert status.tolist() == [0, 0, 0, codec.CORRUPT]


def test_encoding_normalises_records():
    schema = record(("a", ["int", "null"]), ("b", ["string", "null"]), ("n", ["null"]))
    sparse = pa.array([{"a": 1}, {"a": None}], pa.struct([("a", pa.int32())]))
    decoded, status = codec.decode_bodies(codec.encode(schema, sparse), schema, arrow_type(schema))
    assert decoded.to_pylist() == [{"a": 1, "b": None, "n": None}, {"a": None, "b": None, "n": None}]
    with pytest.raises(ValueError, match="not nullable"):
        codec.encode(record(("a", "int")), pa.array([{"a": None}], pa.struct([("a", pa.int32())])))


def test_invalid_utf8_is_an_error_of_that_row():
    schema = record(("s", "string"))
    decoded, status = codec.decode_bodies(pa.array([b"\x02a", b"\x02\xff"], pa.binary()), schema, arrow_type(schema))
    assert decoded[0].as_py() == {"s": "a"} and status.tolist() == [codec.OK, codec.CORRUPT]


def test_unsupported_types_raise_by_default():
    micros = {"type": "long", "logicalType": "timestamp-micros"}
    fixed = {"type": "fixed", "name": "f", "size": 4}
    enum = {"type": "enum", "name": "e", "symbols": ["A"]}
    for bad in (micros, fixed, enum, "some.named.type"):
        with pytest.raises(ValueError):
            schemas.avro_to_struct_type(record(("x", bad)))
    with pytest.raises(ValueError, match="record"):
        schemas.avro_to_struct_type('"string"')
    with pytest.raises(ValueError, match="record"):
        schemas.avro_to_struct_type('{"type": "array", "items": "int"}')
    stamped = record(("x", [micros, "null"]))
    assert schemas.avro_to_struct_type(stamped, logical_types=True)["x"].dataType == T.TimestampType()
    typed = pa.array([{"x": 1_700_000_000_123_456}, {"x": None}], pa.struct([("x", pa.int64())]))
    decoded, status = codec.decode_bodies(codec.encode(stamped, typed), stamped, arrow_type(stamped, True))
    assert not status.any() and decoded[0]["x"].value == 1_700_000_000_123_456


def test_null_only_union_is_a_null_string():
    assert schemas.avro_to_struct_type(record(("x", ["null"])))["x"].dataType == T.StringType()


def test_versions_merge_by_name():
    legacy = record(("id", "long"), ("v", "int"), ("mulens", [record(("a", "double")), "null"]))
    current = record(("v", "double"), ("mulens", ["double", "null"]), ("id", "long"), ("new", "string"))
    merged = schemas.superset([legacy, current])
    assert merged.simpleString() == "struct<v:double,mulens:double,id:bigint,new:string,mulens_legacy:struct<a:double>>"
    target = pa.struct(list(to_arrow_schema(merged)))
    old = codec.encode(legacy, pa.array([{"id": 1, "v": 2, "mulens": {"a": 0.5}}], arrow_type(legacy)))
    decoded, status = codec.decode_bodies(old, legacy, target)
    assert not status.any()
    assert decoded[0].as_py() == {"v": 2.0, "mulens": None, "id": 1, "new": None, "mulens_legacy": {"a": 0.5}}


def test_versions_sort_by_number():
    versions = ["2.7_3.10.1", "1.4_0.5.1_replayed", "2.7_3.9.0", "1.4_0.5.1", "2.2_2.0.0"]
    assert sorted(versions, key=schemas.version_order) == [
        "1.4_0.5.1", "1.4_0.5.1_replayed", "2.2_2.0.0", "2.7_3.9.0", "2.7_3.10.1"]


def test_schema_of_a_frame_round_trips(spark):
    struct = T.StructType.fromDDL(
        "a int, b array<struct<x:double,y:string>>, c map<string,bigint>, d binary, e struct<f:boolean,g:float>"
    )
    assert schemas.avro_to_struct_type(schemas.struct_type_to_avro(struct)) == struct


def test_container_blocks_decode_in_order():
    schema = record(("i", "long"), ("s", ["string", "null"]))
    rng = random.Random(3)
    rows = [{"i": k, "s": None if k % 3 else "x" * rng.randrange(9)} for k in range(50)]
    typed = pa.array(rows, arrow_type(schema))
    bodies = codec.encode(schema, typed).to_pylist()
    cuts = [0, 1, 1, 20, 43, 50]
    payloads = [b"".join(bodies[a:b]) for a, b in zip(cuts, cuts[1:])]
    decoded = codec.decode_blocks(payloads, list(np.diff(cuts)), schema, typed.type)
    assert decoded.to_pylist() == rows
    with pytest.raises(ValueError, match="corrupt"):
        codec.decode_blocks([payloads[0] + b"x"], [1], schema, typed.type)


def test_nan_is_not_null():
    schema = record(("x", ["double", "null"]), ("y", ["float", "null"]))
    typed = pa.array([{"x": float("nan"), "y": None}, {"x": None, "y": float("nan")}], arrow_type(schema))
    decoded, status = codec.decode_bodies(codec.encode(schema, typed), schema, typed.type)
    assert not status.any()
    for name in ("x", "y"):
        assert decoded.field(name).null_count == 1 and typed.field(name).is_valid().equals(decoded.field(name).is_valid())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.recursive(_leaf, _wrap, max_leaves=5), min_size=1, max_size=3), st.integers(0, 10**6), st.sampled_from([7, 64, 1 << 15]))
def test_long_blocks_round_trip(types, seed, window):
    """Arrays read as one vector give what arrays read slot by slot give."""
    schema = record(*[(f"c{i}", {"type": "array", "items": t}) for i, t in enumerate(types)])
    typed = pa.array(alerts.rows(schema, 17, seed), arrow_type(schema))
    bodies = codec.encode(schema, typed)
    before = codec.LONG_BLOCK, codec.WINDOW
    codec.LONG_BLOCK, codec.WINDOW = 2, window
    try:
        decoded, status = codec.decode_bodies(bodies, schema, typed.type)
        cut = pa.array([b[: len(b) // 2] if k % 2 else b for k, b in enumerate(bodies.to_pylist())], pa.binary())
        _, broken = codec.decode_bodies(cut, schema, typed.type)
    finally:
        codec.LONG_BLOCK, codec.WINDOW = before
    assert not status.any() and decoded.to_pylist() == typed.to_pylist()
    _, expected = codec.decode_bodies(cut, schema, typed.type)
    assert broken.tolist() == expected.tolist()


def test_an_array_of_many_items_takes_few_steps(monkeypatch):
    item = record(("jd", "double"), ("mag", ["float", "null"]), ("n", "long"), ("tag", "string"), ("nothing", "null"))
    schema = record(("id", "long"), ("points", {"type": "array", "items": item}), ("empty", {"type": "array", "items": "null"}), ("end", "string"))
    rng = random.Random(5)
    points = [dict(jd=rng.random(), mag=None if rng.random() < 0.3 else 0.5 * k, n=rng.randrange(-(2**40), 2**40), tag="x" * rng.randrange(200), nothing=None) for k in range(100_000)]
    rows = [dict(id=1, points=points, empty=[None] * 5000, end="e"), dict(id=2, points=points[:3], empty=[], end="f")]
    typed = pa.array(rows, arrow_type(schema))
    steps = []
    real = codec.BodyReader.read
    monkeypatch.setattr(codec.BodyReader, "read", lambda self, t, r, target: steps.append(1) or real(self, t, r, target))
    decoded, status = codec.decode_bodies(codec.encode(schema, typed), schema, typed.type)
    assert not status.any() and decoded.equals(typed)
    assert len(steps) < 6000  # slot by slot: 500,000
