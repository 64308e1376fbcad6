import json
import os

import pytest
from pyspark.sql import functions as F

import alerts
from skytide.naming import Naming
from skytide.operators import decode
from skytide.sources.avro_schema import avro_to_struct_type, superset
from skytide.sources.topic_log import LOG_SCHEMA

SCHEMA = alerts.ztf_schema()
MOVED = alerts.ztf_schema(moved="roid")
OLD = alerts.ztf_schema(drop=("mulens",))
NEW = alerts.ztf_schema(extra=[("tracklet", "string")])


def bodies(spark, schema, n, seed):
    df = spark.createDataFrame(alerts.rows(schema, n, seed), avro_to_struct_type(schema))
    return [r.value for r in decode.encode_alerts(df.coalesce(1), schema).collect()]


@pytest.fixture(scope="module")
def log(spark):
    rows = []
    for key, schema, n in (
        (json.dumps(NEW), NEW, 4),
        ("2.7", SCHEMA, 5),
        ("1.0", OLD, 3),
        ("2.7", MOVED, 2),
        (None, SCHEMA, 1),
    ):
        for value in bodies(spark, schema, n, len(rows)):
            raw = None if key is None else bytearray(key.encode())
            rows.append((raw, value, "t", len(rows) % 2, len(rows) // 2, None, 0))
    return spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1)


REGISTRY = {"2.7": json.dumps(SCHEMA), "2.7_replayed": json.dumps(MOVED), "1.0": json.dumps(OLD), "": json.dumps(SCHEMA)}
TARGET = superset([OLD, SCHEMA, NEW])


def expected():
    out = []
    for schema, n, seed in ((NEW, 4, 0), (SCHEMA, 5, 4), (OLD, 3, 9), (MOVED, 2, 12), (SCHEMA, 1, 14)):
        out += [(r["objectId"], r.get("mulens"), r.get("tracklet"), r["roid"]) for r in alerts.rows(schema, n, seed)]
    return out


def picked(rows):
    rows = sorted(rows, key=lambda r: (r.offset, r.partition))
    return [(r.alert.objectId, r.alert.mulens, r.alert.tracklet, r.alert.roid) for r in rows]


def test_every_way_to_name_a_schema(spark, log):
    rows = decode.decode_alerts(log, TARGET, REGISTRY).collect()
    assert picked(rows) == expected()
    rows.sort(key=lambda r: (r.offset, r.partition))
    assert [r.replayed for r in rows] == [False] * 12 + [True] * 2 + [False]
    assert all(r.error is None for r in rows)


def test_schema_id_column(spark, log):
    ids = {r.schema_id for r in decode.resolve_schemas(log).select("schema_id").collect()}
    assert {"2.7", "1.0", ""} < ids and len(ids) == 4
    given = {r.schema_id for r in decode.resolve_schemas(log, "{}").select("schema_id").collect()}
    assert decode.OVERRIDE_ID in given and "2.7" not in given and len(given) == 2


def test_override_beats_the_version_but_not_a_schema_key(spark, log):
    only = log.filter("key is null or cast(key as string) like '{%'")
    rows = decode.decode_alerts(only, TARGET, override=SCHEMA).collect()
    assert picked(rows) == expected()[:4] + expected()[-1:]


def test_wrong_order_without_its_twin_is_reported(spark, log):
    short = {k: v for k, v in REGISTRY.items() if k != "2.7_replayed"}
    rows = decode.decode_alerts(log, TARGET, short, mode="PERMISSIVE").collect()
    bad = [r for r in rows if r.error is not None]
    assert len(bad) == 2 and all(r.alert is None and r.schema_id == "2.7" and r.topic == "t" for r in bad)
    with pytest.raises(Exception, match="cannot decode message .*'topic': 't'"):
        decode.decode_alerts(log, TARGET, short).collect()


def test_unknown_schema_is_a_dead_letter(spark, log):
    rows = decode.decode_alerts(log, TARGET, {"2.7": REGISTRY["2.7"]}, mode="PERMISSIVE").collect()
    assert {r.error for r in rows if r.schema_id == "1.0"} == {"unknown schema '1.0'"}
    assert sum(r.error is None for r in rows) == 9
    with pytest.raises(ValueError):
        decode.decode_alerts(log, TARGET, mode="DROPMALFORMED")


def test_chosen_columns_only(spark, log):
    df = decode.decode_alerts(log, TARGET, REGISTRY, columns=["objectId", "candidate.jd"])
    assert df.schema["alert"].dataType.simpleString() == "struct<objectId:string,candidate:struct<jd:double>>"
    assert df.filter("alert is null").count() == 0


def test_schema_table_and_topic_schema(spark, log):
    table = decode.schema_table(log).collect()
    assert [(r.topic, json.loads(r.schema_json)) for r in table] == [("t", NEW)]
    assert json.loads(table[0].spark_schema_json) == json.loads(avro_to_struct_type(NEW).json())
    registry = decode.load_registry(decode.schema_table(log))
    assert list(registry) == [table[0].schema_id]
    announced = log.withColumn("topic", F.lit("x_schema"))
    assert json.loads(decode.topic_schema(announced, "x")) == NEW
    with pytest.raises(LookupError):
        decode.topic_schema(log, "x")


def test_registry_of_a_folder(spark, path):
    naming = Naming(namespace="night")
    os.makedirs(path)
    for version, schema in (("2.7", SCHEMA), ("2.7_replayed", MOVED)):
        with open(f"{path}/{naming.schema_file(version)}", "w") as out:
            json.dump(schema, out)
    with open(f"{path}/readme.txt", "w") as out:
        out.write("no schema")
    registry = decode.load_registry(decode.registry_from_folder(spark, path, naming))
    assert {k: json.loads(v) for k, v in registry.items()} == {"2.7": SCHEMA, "2.7_replayed": MOVED}


def test_simple_record_identity(spark):
    schema = {"type": "record", "name": "u", "fields": [{"name": "name", "type": "string"}, {"name": "fav_num", "type": "int"}]}
    df = spark.createDataFrame([("Alice", 63)], "name string, fav_num int")
    raw = decode.encode_alerts(df, schema).select(F.lit(None).cast("binary").alias("key"), "value")
    back = decode.decode_alerts(raw, avro_to_struct_type(schema), override=schema).select("alert.*")
    assert [tuple(r) for r in back.collect()] == [("Alice", 63)]
