import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

import alerts
from skytide.session import scratch_path
from skytide.sources import avro_files
from skytide.sources.avro_files import list_files, read_alerts, write_avro
from skytide.sources.avro_schema import avro_to_struct_type


@pytest.fixture(scope="module")
def folder(spark):
    """Three files of a full-width schema, 7 alerts in all, and the frame they hold."""
    schema = alerts.ztf_schema()
    df = spark.createDataFrame(alerts.rows(schema, 7), avro_to_struct_type(schema)).repartition(3)
    df = df.cache()
    path = scratch_path(spark, "avro-test")
    write_avro(df, path, schema)
    return path, df, schema


def files(path):
    return sorted(glob.glob(path + "/*.avro"))


def test_folder_round_trip(spark, folder):
    path, df, _ = folder
    back = read_alerts(spark, path)
    assert back.schema == df.schema
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_path_forms(spark, folder):
    path, df, _ = folder
    names = files(path)
    assert len(names) == 3
    sizes = [read_alerts(spark, n).count() for n in names]
    assert sum(sizes) == 7
    assert read_alerts(spark, names[:2]).count() == sizes[0] + sizes[1]
    with pytest.warns(UserWarning):
        assert read_alerts(spark, "").count() == 0
    with pytest.raises(IOError):
        read_alerts(spark, path + "/missing.avro")


def test_size_limits_files_then_records(spark, folder):
    path, _, _ = folder
    first_two = sum(read_alerts(spark, n).count() for n in files(path)[:2])
    assert read_alerts(spark, path, size=2).count() == min(2, first_two)
    assert read_alerts(spark, path, size=1).count() == 1


def test_gzip_and_other_suffixes(spark, folder, path):
    source, df, _ = folder
    os.makedirs(path)
    name = files(source)[0]
    with open(name, "rb") as raw, open(path + "/one.avro.gz", "wb") as out:
        out.write(gzip.compress(raw.read()))
    expected = read_alerts(spark, name)
    assert sorted(map(str, read_alerts(spark, path + "/one.avro.gz").collect())) == sorted(map(str, expected.collect()))
    with open(path + "/two.avro.zip", "wb") as out:
        out.write(b"x")
    with pytest.raises(NotImplementedError):
        read_alerts(spark, path)
    # Only files right inside the folder count.
    os.makedirs(path + "/sub.avro")
    assert [os.path.basename(f) for f, _ in list_files(path)] == ["one.avro.gz", "two.avro.zip"]


def test_column_choice(spark, folder):
    path, df, _ = folder
    narrow = read_alerts(spark, path, columns=["objectId", "candidate.jd", "prv_candidates.magpsf"])
    expected = df.select("objectId", F.struct("candidate.jd"), "prv_candidates.magpsf")
    flat = narrow.select("objectId", F.struct("candidate.jd"), "prv_candidates.magpsf")
    assert sorted(map(str, flat.collect())) == sorted(map(str, expected.collect()))


def test_versions_are_merged_by_name(spark, folder, path):
    _, df, schema = folder
    write_avro(df, path, schema)
    other = alerts.ztf_schema(extra=[("tracklet", "string")], drop=("mulens",), moved="roid")
    newer = df.drop("mulens").withColumn("tracklet", F.lit("t"))
    write_avro(newer, path, other, mode="append")
    merged = read_alerts(spark, path)
    assert {"mulens", "tracklet"} <= set(merged.columns)
    assert merged.filter("tracklet is null").count() == 7 and merged.count() == 14
    ids = [r.objectId for r in merged.filter("tracklet is not null").collect()]
    assert sorted(map(str, ids)) == sorted(str(r.objectId) for r in df.collect())


def test_many_headers_are_read_by_a_job(spark, folder):
    path, _, schema = folder
    got = avro_files.distinct_file_schemas(spark, avro_files.list_files(path) * 3)
    assert [len(s) > 0 for s in got] == [True]


def test_headers_of_a_manifest_are_not_read_again(spark, folder, path, monkeypatch):
    _, df, schema = folder
    manifest = path + "-headers"
    write_avro(df, path, schema)
    first = read_alerts(spark, path, manifest=manifest)
    assert first.count() == 7 and spark.read.parquet(manifest).count() == len(files(path))
    known = set(files(path))
    write_avro(df.withColumn("tracklet", F.lit("t")), path, alerts.ztf_schema(extra=[("tracklet", "string")]), mode="append")
    for file in known:  # headers that are known are not looked at: here they no longer are any
        with open(file, "r+b") as out:
            out.write(b"XXXX")
    got = avro_files.distinct_file_schemas(spark, avro_files.list_files(path), manifest)
    assert len(got) == 2 and spark.read.parquet(manifest).count() == len(files(path))


def test_large_files_are_cut_at_sync_markers(spark, path):
    df = spark.range(20000).select("id", (F.col("id") * 7 % 1000).cast("string").alias("s")).coalesce(1)
    for compression in ("null", "deflate"):
        out = f"{path}-{compression}"
        write_avro(df, out, compression=compression)
        reader = spark.read.format("alert_avro").option("maxPartitionBytes", "9000")
        back = reader.load(out)
        assert back.rdd.getNumPartitions() > 5
        assert back.count() == 20000 and back.distinct().count() == 20000
        assert back.exceptAll(df).isEmpty()


def test_existing_target(spark, path):
    df = spark.range(5)
    write_avro(df, path)
    with pytest.raises(IOError, match="already exists"):
        write_avro(df, path)
    write_avro(spark.range(3), path, mode="overwrite")
    assert read_alerts(spark, path).count() == 3
    write_avro(df, path, mode="append")
    assert read_alerts(spark, path).count() == 8
    with pytest.raises(ValueError):
        write_avro(df, path, mode="ignore")


def test_failed_write_leaves_nothing(spark, path):
    bad = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).alias("id")).coalesce(1)
    strict = {"type": "record", "name": "r", "fields": [{"name": "id", "type": "long"}]}
    with pytest.raises(Exception, match="not nullable"):
        write_avro(bad, path, strict)
    assert not os.path.exists(path) or os.listdir(path) == []
