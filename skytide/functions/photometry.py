"""Magnitudes, bands and point-quality predicates as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# AB zero point for nJy, and the bands that are plotted.
AB_ZERO_POINT = 31.4
ZTF_BANDS = {1: "g", 2: "r"}
LSST_BANDS = ("u", "g", "r", "i", "z", "y")


def _col(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def flux_to_mag(flux: Column | str, flux_err: Column | str) -> tuple[Column, Column]:
    """Magnitude and error with IEEE results where SQL would give null or fail.

    Zero flux has magnitude +inf, negative flux NaN; null stays null.
    """
    f, e = (_col(flux), _col(flux_err))
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    mag = (
        F.when(f.isNull(), F.lit(None).cast("double"))
        .when(f > 0, F.lit(AB_ZERO_POINT) - F.lit(2.5) * F.log10(f))
        .when(f == 0, inf)
        .otherwise(nan)
    )
    zero_flux_err = F.when(F.isnan(e) | (e == 0), nan).when(e > 0, inf).otherwise(-inf)
    err = (
        F.when(f.isNull() | e.isNull(), F.lit(None).cast("double"))
        .when(f == 0, zero_flux_err)
        .otherwise(F.lit(2.5 / math.log(10)) * e / f)
    )
    # Spark orders NaN above every number, so a NaN flux must be caught first.
    return F.when(F.isnan(f), nan).otherwise(mag), err


def ztf_band(fid: Column | str) -> Column:
    """Band letter of a ZTF filter id; null for the bands that are not shown."""
    c = F.col(fid) if isinstance(fid, str) else fid
    return F.when(c == 1, F.lit(ZTF_BANDS[1])).when(c == 2, F.lit(ZTF_BANDS[2]))


def is_lsst_band(band: Column | str) -> Column:
    return (F.col(band) if isinstance(band, str) else band).isin(*LSST_BANDS)


def is_missing(mag: Column | str, nan_is_missing: bool = True) -> Column:
    c = F.col(mag) if isinstance(mag, str) else mag
    return (c.isNull() | F.isnan(c)) if nan_is_missing else c.isNull()


def detection_tag(mag: Column | str, nan_is_missing: bool = True) -> Column:
    return F.when(is_missing(mag, nan_is_missing), "upperlim").otherwise("valid")


def detection_value(mag: Column | str, limit: Column | str, nan_is_missing: bool = True) -> Column:
    """The magnitude of a detection, or the limiting magnitude."""
    m = F.col(mag) if isinstance(mag, str) else mag
    lim = F.col(limit) if isinstance(limit, str) else limit
    return F.when(is_missing(m, nan_is_missing), lim).otherwise(m)


def has_positive_error(mag_err: Column | str) -> Column:
    """``mag_err > 0`` the IEEE way: NaN compares false, infinity true."""
    c = F.col(mag_err) if isinstance(mag_err, str) else mag_err
    return c.isNotNull() & ~F.isnan(c) & (c > 0)


def quality_points(df: DataFrame, tag: str = "tag") -> DataFrame:
    """Keep plotted points of a tagged history and pick their y value.

    ``valid`` and ``badquality`` rows use the magnitude and its error,
    ``upperlim`` rows the limiting magnitude, and only if that column exists.
    """
    tags = ["valid", "badquality"]
    y = F.col("magpsf")
    y_err = F.col("sigmapsf")
    if "diffmaglim" in df.columns:
        tags.append("upperlim")
        upper = F.col(tag) == "upperlim"
        y = F.when(upper, F.col("diffmaglim")).otherwise(y)
        y_err = F.when(~upper, y_err)
    return (
        df.filter(F.col(tag).isin(*tags) & F.col("fid").isin(*ZTF_BANDS))
        .withColumn("band", ztf_band("fid"))
        .withColumn("y", y)
        .withColumn("y_err", y_err)
    )
