"""Time columns: Julian dates to timestamps, TAI to UTC, date partitions.

Plain column arithmetic throughout, so everything stays in generated code.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

JD_OF_UNIX_EPOCH = 2440587.5
MJD_OF_UNIX_EPOCH = 40587.0
JD_MINUS_MJD = 2400000.5
MS_PER_DAY = 86400000
# Days since 1970 of 0001-01-01 and 10000-01-01: what a timestamp can print.
_FIRST_DAY, _LAST_DAY = -719162, 2932896

# Fixed values (public IERS list): first UTC day and TAI-UTC in seconds.
LEAP_SECONDS = (
    ("1972-01-01", 10), ("1972-07-01", 11), ("1973-01-01", 12), ("1974-01-01", 13),
    ("1975-01-01", 14), ("1976-01-01", 15), ("1977-01-01", 16), ("1978-01-01", 17),
    ("1979-01-01", 18), ("1980-01-01", 19), ("1981-07-01", 20), ("1982-07-01", 21),
    ("1983-07-01", 22), ("1985-07-01", 23), ("1988-01-01", 24), ("1990-01-01", 25),
    ("1991-01-01", 26), ("1992-07-01", 27), ("1993-07-01", 28), ("1994-07-01", 29),
    ("1996-01-01", 30), ("1997-07-01", 31), ("1999-01-01", 32), ("2006-01-01", 33),
    ("2009-01-01", 34), ("2012-07-01", 35), ("2015-07-01", 36), ("2017-01-01", 37),
)


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _days_to_millis(days: Column) -> Column:
    """Whole milliseconds since 1970; null for null, NaN and unprintable days."""
    ok = ~F.isnan(days) & (days >= _FIRST_DAY) & (days < _LAST_DAY)
    return F.when(ok, F.round(days * MS_PER_DAY).cast("bigint"))


def unix_days(c: Column | str, fmt: str) -> Column:
    """Days since 1970-01-01 of a ``jd`` or ``mjd`` column."""
    value = _as_column(c).cast("double")
    if fmt == "jd":
        return value - F.lit(JD_OF_UNIX_EPOCH)
    if fmt == "mjd":
        return value - F.lit(MJD_OF_UNIX_EPOCH)
    raise ValueError(f"unknown time format {fmt!r}, expected 'jd' or 'mjd'")


def jd_to_timestamp(c: Column | str) -> Column:
    return F.timestamp_millis(_days_to_millis(unix_days(c, "jd")))


def mjd_to_timestamp(c: Column | str) -> Column:
    """MJD read in its own time scale (no TAI to UTC step)."""
    return F.timestamp_millis(_days_to_millis(unix_days(c, "mjd")))


def tai_minus_utc(millis: Column) -> Column:
    """Seconds by which TAI is ahead at a TAI instant; null before 1972."""
    offset = F.lit(None).cast("int")
    for day, seconds in LEAP_SECONDS:
        start = (date.fromisoformat(day) - date(1970, 1, 1)).days * MS_PER_DAY + seconds * 1000
        offset = F.when(millis >= F.lit(start), F.lit(seconds)).otherwise(offset)
    return offset


def mjd_tai_to_timestamp(c: Column | str) -> Column:
    millis = _days_to_millis(unix_days(c, "mjd"))
    return F.timestamp_millis(millis - tai_minus_utc(millis) * F.lit(1000))


def jd_to_mjd(c: Column | str) -> Column:
    return _as_column(c) - F.lit(JD_MINUS_MJD)


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def date_parts(c: Column | str, fmt: str) -> dict[str, Column]:
    """``year``, ``month``, ``day`` as zero-padded text, all null for a bad time.

    The day is the one of the column's own scale: a TAI time gives a TAI day.
    """
    ts = F.timestamp_millis(_days_to_millis(unix_days(c, fmt)))
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def days_from_last(times: Column | str) -> Column:
    """Each time minus the last element; array order is kept as it is."""
    t = _as_column(times)
    return F.transform(t, lambda x: x - F.element_at(t, -1))


def days_from_first(times: Column | str) -> Column:
    t = _as_column(times)
    return F.transform(t, lambda x: x - F.element_at(t, 1))


def received_at() -> Column:
    """Time of receipt in whole seconds."""
    return F.date_trunc("second", F.current_timestamp())
