import pytest
from pyspark.sql import functions as F

from skytide.operators import lightcurve
from skytide.operators.archive import append_parquet
from skytide.session import open_filesystem
from skytide.sources.log_index import list_parquet
from skytide.sources.object_index import files_of, index_objects


def add(spark, path, day, objects):
    rows = [(f"o{k}", float(k), day) for k in objects]
    append_parquet(spark.createDataFrame(rows, "objectId string, jd double, day string").coalesce(1), path, ["day"], lookup=["objectId"])


def history(spark, path, ids):
    found = lightcurve.object_history(spark, path, ids, ["jd", "day"])
    return sorted((r.objectId, r.jd, r.day) for r in found.collect()), {f.split("day=")[1].split("/")[0] for f in found.inputFiles()}


def test_only_files_that_hold_the_objects_are_opened(spark, path):
    for day in range(12):
        add(spark, path, f"2024+{day:02d} %", [day, day + 1, 100])
    everything = history(spark, path, ["o5"])
    assert len(everything[1]) == 12
    assert index_objects(spark, path, "objectId") == 12 and index_objects(spark, path, "objectId") == 0
    rows, opened = history(spark, path, ["o5", "o0"])
    assert len(opened) == 3 and [r[0] for r in rows] == ["o0", "o5", "o5"]
    table = spark.createDataFrame([("o5",), ("o5",), (None,)], "objectId string")
    assert history(spark, path, table)[0] == everything[0] and len(history(spark, path, table)[1]) == 2
    assert history(spark, path, ["nobody"]) [0] == []
    assert len(history(spark, path, ["o100"])[0]) == 12


def test_files_the_index_does_not_know_are_read(spark, path):
    add(spark, path, "a", [1, 2])
    index_objects(spark, path, "objectId")
    add(spark, path, "b", [1, 3])
    rows, opened = history(spark, path, ["o3"])
    assert rows == [("o3", 3.0, "b")] and len(opened) == 1
    index_objects(spark, path, "objectId")
    filesystem, inner = open_filesystem(path)
    [gone] = [f for f in list_parquet(path) if "day=a" in f]
    filesystem.delete_file(f"{inner}/{gone}")
    assert [r[2] for r in history(spark, path, ["o1"])[0]] == ["b"]
    assert files_of(spark, path, "objectId", ["o1"], max_files=0) is None  # too many: the whole archive
    assert files_of(spark, path, "jd", [1.0]) is None


POINT = "struct<midpointMjdTai: double, psfFlux: double, psfFluxErr: double, band: string>"


def test_band_statistics_in_the_row(spark):
    def point(flux, err, band):
        return (1.0, flux, err, band)

    inf, nan = float("inf"), float("nan")
    rows = [
        (1, point(100.0, 10.0, "g"), [point(1000.0, 10.0, "g"), point(-5.0, 1.0, "g"), point(0.0, 1.0, "r"), point(nan, 1.0, "r"), point(None, 1.0, None)]),
        (2, point(10.0, -1.0, "u"), None),
    ]
    frame = spark.createDataFrame(rows, f"diaSourceId long, diaSource {POINT}, prvDiaSources array<{POINT}>")
    stats = lightcurve.band_statistics(frame, "lsst")
    assert "Exchange" not in stats._jdf.queryExecution().executedPlan().toString()
    got = {(r.diaSourceId, r.band): (r.n_points, r.n_shown, r.mag_min, r.magerr_max) for r in stats.collect()}
    assert set(got) == {(1, "g"), (1, "r"), (1, None), (2, "u")}
    assert got[1, "g"][:2] == (3, 2) and got[1, "g"][2] == pytest.approx(31.4 - 7.5) and got[1, "g"][3] == pytest.approx(0.10857362)
    assert got[1, "r"] == (2, 1, inf, None) and got[1, None] == (1, 0, None, None) and got[2, "u"] == (1, 0, None, None)
    long = lightcurve.lightcurve(frame, "lsst").groupBy("diaSourceId", "band").agg(F.count(F.lit(1)).alias("n"))
    assert {(r.diaSourceId, r.band): r.n for r in long.collect()} == {k: v[0] for k, v in got.items()}


def test_band_statistics_of_ztf(spark):
    kind = "struct<jd: double, fid: int, magpsf: float, sigmapsf: float, diffmaglim: float>"
    rows = [("a", 1, (1.0, 1, 17.5, 0.1, 20.0), [(0.5, 1, None, None, 20.0), (0.4, 2, float("nan"), 0.2, 20.0), (0.3, 3, 16.0, 0.3, 20.0), (0.2, 1, 17.0, 0.4, 20.0)])]
    frame = spark.createDataFrame(rows, f"objectId string, candid long, candidate {kind}, prv_candidates array<{kind}>")
    got = {r.band: (r.n_points, r.n_shown, r.mag_min, round(r.magerr_max, 3) if r.magerr_max else None) for r in lightcurve.band_statistics(frame, "ztf").collect()}
    assert got == {"g": (3, 2, 17.0, 0.4), "r": (1, 0, None, None), None: (1, 1, 16.0, 0.3)}
