import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from skytide.functions import photometry, text, timeconv
from skytide.naming import Naming, layout

UTC = dt.timezone.utc


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("out")).first().out


@pytest.mark.parametrize(
    "jd, expected",
    [
        (2459540.856319433, "2021-11-22 08:33:05.999"),
        (2440587.5, "1970-01-01 00:00:00.000"),
        (None, None),
        (float("nan"), None),
        (float("inf"), None),
        (1e300, None),
    ],
)
def test_jd_to_text(spark, jd, expected):
    assert one(spark, jd, "double", lambda c: timeconv.iso_millis(timeconv.jd_to_timestamp(c))) == expected


@pytest.mark.parametrize(
    "utc, offset",
    [("1972-01-01", 10), ("1998-12-31", 31), ("1999-01-01", 32), ("2016-12-31", 36), ("2017-01-01", 37), ("2030-06-01", 37)],
)
def test_tai_to_utc_by_year(spark, utc, offset):
    day = (dt.date.fromisoformat(utc) - dt.date(1858, 11, 17)).days
    tai = day + 0.25 + offset / 86400
    got = one(spark, tai, "double", lambda c: timeconv.iso_millis(timeconv.mjd_tai_to_timestamp(c)))
    assert got == f"{utc} 06:00:00.000"


def test_tai_before_leap_seconds_is_null(spark):
    assert one(spark, 40000.0, "double", timeconv.mjd_tai_to_timestamp) is None


def test_partition_day_is_the_tai_day_but_display_is_utc(spark):
    # 20 s after TAI midnight is still the evening before in UTC.
    tai = 60310 + 20 / 86400
    df = spark.createDataFrame([(tai,)], "t double")
    row = df.select(
        *[c.alias(n) for n, c in timeconv.date_parts("t", "mjd").items()],
        timeconv.iso_millis(timeconv.mjd_tai_to_timestamp("t")).alias("shown"),
    ).first()
    assert (row.year, row.month, row.day) == ("2024", "01", "01")
    assert row.shown == "2023-12-31 23:59:43.000"


def test_millisecond_rounding_moves_the_day(spark):
    before_midnight = 2460311.5 - 0.2e-3 / 86400
    parts = timeconv.date_parts("t", "jd")
    row = spark.createDataFrame([(before_midnight,)], "t double").select(parts["day"].alias("d")).first()
    assert row.d == "02"


def test_days_are_relative_to_array_ends_without_sorting(spark):
    df = spark.createDataFrame([([5.0, 9.0, 2.0],)], "t array<double>")
    row = df.select(timeconv.days_from_last("t").alias("a"), timeconv.days_from_first("t").alias("b")).first()
    assert row.a == [3.0, 7.0, 0.0] and row.b == [0.0, 4.0, -3.0]


@pytest.mark.parametrize(
    "flux, err, mag, mag_err, shown",
    [
        (100.0, 1.0, 26.4, 0.0108573620, True),
        (0.0, 1.0, math.inf, math.inf, True),
        (-5.0, 1.0, math.nan, -0.2171472410, False),
        (None, 1.0, None, None, False),
        (math.nan, 1.0, math.nan, math.nan, False),
        (0.0, 0.0, math.inf, math.nan, False),
        (5.0, None, 31.4 - 2.5 * math.log10(5), None, False),
    ],
)
def test_flux_to_mag(spark, flux, err, mag, mag_err, shown):
    m, e = photometry.flux_to_mag("f", "e")
    df = spark.createDataFrame([(flux, err)], "f double, e double").select(m.alias("m"), e.alias("e"))
    row = df.withColumn("shown", photometry.has_positive_error("e")).first()

    def same(a, b):
        return a is None and b is None or a is not None and (math.isnan(a) and math.isnan(b) or a == pytest.approx(b))

    assert same(row.m, mag) and same(row.e, mag_err) and row.shown is shown


def test_detection_or_limit(spark):
    df = spark.createDataFrame([(18.5, 20.0), (None, 20.5), (math.nan, 21.0)], "m double, lim double")
    rows = df.select(
        photometry.detection_tag("m").alias("tag"),
        photometry.detection_value("m", "lim").alias("y"),
        photometry.detection_tag("m", nan_is_missing=False).alias("strict"),
    ).collect()
    assert [(r.tag, r.y) for r in rows] == [("valid", 18.5), ("upperlim", 20.5), ("upperlim", 21.0)]
    assert [r.strict for r in rows] == ["valid", "upperlim", "valid"]


def test_quality_points_with_and_without_limits(spark):
    data = [(1, "valid", 18.0, 0.1, 20.0), (2, "upperlim", None, None, 20.5), (1, "badquality", 19.0, 0.5, 20.0),
            (3, "valid", 17.0, 0.1, 20.0), (1, "other", 17.0, 0.1, 20.0)]
    df = spark.createDataFrame(data, "fid int, tag string, magpsf double, sigmapsf double, diffmaglim double")
    rows = photometry.quality_points(df).collect()
    assert {(r.band, r.tag, r.y, r.y_err) for r in rows} == {
        ("g", "valid", 18.0, 0.1), ("r", "upperlim", 20.5, None), ("g", "badquality", 19.0, 0.5)}
    assert photometry.quality_points(df.drop("diffmaglim")).count() == 2


def test_names_and_escapes(spark):
    assert one(spark, "IaMEvi\\l", "string", text.legal_topic_name) == "iamevil"
    assert one(spark, "SN_candidate-2é", "string", text.legal_topic_name) == "sncandidateé"
    specials = "_*[]()~>#+-=|{}.!"
    assert one(spark, specials + "a`\\", "string", text.escape_markdown) == "".join("\\" + c for c in specials) + "a`\\"
    naming = Naming(namespace="night")
    assert one(spark, "in_tns", "string", lambda c: text.tag_topic_name(c, naming)) == "night_in_tns_lsst"


def test_unknown_survey_or_time_format_is_an_error(spark):
    with pytest.raises(ValueError):
        layout("gaia")
    with pytest.raises(ValueError):
        timeconv.date_parts("t", "iso")


def test_received_at_is_whole_seconds(spark):
    got = spark.range(1).select(timeconv.received_at().alias("t")).first().t
    assert got.microsecond == 0
