"""Alert schemas and rows for the tests, built by rule with a fixed seed."""

from __future__ import annotations

import random

_CURRENT = [("jd", "double"), ("fid", "int"), ("diffmaglim", "float"), ("magpsf", "float"), ("sigmapsf", "float"),
            ("candid", "long"), ("isdiffpos", "string"), ("ra", "double"), ("dec", "double")]


def _fields(pairs):
    return [{"name": n, "type": [t, "null"]} for n, t in pairs]


def wide(prefix, n):
    return [(f"{prefix}{i}", ("float", "int", "string", "double")[i % 4]) for i in range(n)]


def _record(name, fields):
    return {"type": "record", "name": name, "fields": fields}


def _cutout(kind):
    return {"name": f"cutout{kind}", "type": _record(f"cutout{kind}", [
        {"name": "fileName", "type": ["string", "null"]}, {"name": "stampData", "type": ["bytes", "null"]}])}


def ztf_schema(extra=(), drop=(), moved=None):
    """A ZTF-shaped schema with 100 candidate fields; ``moved`` puts that field first."""
    current = _fields(_CURRENT + wide("c", 91))
    past = {"type": "array", "items": [_record("prv_candidate", _fields(_CURRENT + wide("p", 48))), "null"]}
    fields = [
        *_fields([("schemavsn", "string"), ("publisher", "string"), ("objectId", "string"), ("candid", "long")]),
        {"name": "candidate", "type": _record("candidate", current)},
        {"name": "prv_candidates", "type": [past, "null"]},
        *[_cutout(k) for k in ("Science", "Template", "Difference")],
        *_fields([("cdsxmatch", "string"), ("roid", "int"), ("rf_snia_vs_nonia", "double"), ("mulens", "double")]),
        *_fields(extra),
    ]
    fields = [f for f in fields if f["name"] not in drop]
    if moved:
        fields.sort(key=lambda f: f["name"] != moved)
    return {"type": "record", "name": "alert", "namespace": "ztf", "fields": fields}


def value(avro_type, rng):
    if isinstance(avro_type, list):
        branch = next(b for b in avro_type if b != "null")
        return None if "null" in avro_type and rng.random() < 0.2 else value(branch, rng)
    if isinstance(avro_type, dict):
        if avro_type["type"] == "record":
            return {f["name"]: value(f["type"], rng) for f in avro_type["fields"]}
        if avro_type["type"] == "array":
            return [value(avro_type["items"], rng) for _ in range(rng.randrange(5))]
        if avro_type["type"] == "map":
            return [(f"k{i}", value(avro_type["values"], rng)) for i in range(rng.randrange(4))]
        avro_type = avro_type["type"]
    return {
        "boolean": lambda: rng.random() < 0.5,
        "int": lambda: rng.randrange(-(2**31), 2**31) >> rng.randrange(31),
        "long": lambda: rng.randrange(-(2**63), 2**63) >> rng.randrange(63),
        "float": lambda: rng.randrange(-1000, 1000) / 8,
        "double": lambda: rng.gauss(0, 1e3),
        "string": lambda: "".join(rng.choice("aé€x😀 ") for _ in range(rng.randrange(6))),
        "bytes": lambda: rng.randbytes(rng.randrange(200)),
    }[avro_type]()


def rows(schema, n, seed=7):
    rng = random.Random(seed)
    return [value(schema, rng) for _ in range(n)]
