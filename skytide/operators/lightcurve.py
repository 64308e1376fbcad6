"""Light curves: current measurement and history as arrays or as a long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytide.functions.photometry import (
    detection_tag,
    detection_value,
    flux_to_mag,
    has_positive_error,
    is_lsst_band,
    is_missing,
    ztf_band,
)
from skytide.naming import layout
from skytide.session import broadcast_if_small
from skytide.sources.object_index import read_objects


def _struct_of(df: DataFrame, name: str) -> T.StructType:
    data_type = df.schema[name].dataType
    return data_type.elementType if isinstance(data_type, T.ArrayType) else data_type


def extract_history(df: DataFrame, field: str, history: str, like: T.DataType | None = None) -> Column:
    """One field of every history element; nulls of the same length if the
    history does not carry it."""
    struct = _struct_of(df, history)
    if field in struct.fieldNames():
        return F.col(f"{history}.{field}")
    return F.transform(F.col(history), lambda _: F.lit(None).cast(like or T.StringType()))


def extract_field(df: DataFrame, field: str, current: str, history: str) -> Column:
    """Current value first, then the history; a null history adds nothing.

    Built from field reads only, so the scan fetches just that nested field.
    """
    data_type = _struct_of(df, current)[field].dataType
    past = extract_history(df, field, history, data_type).cast(T.ArrayType(data_type))
    empty = F.array().cast(T.ArrayType(data_type))
    return F.concat(F.array(F.col(f"{current}.{field}")), F.coalesce(past, empty))


def lightcurve(
    df: DataFrame,
    survey: str,
    ids: list[str] | None = None,
    nan_is_missing: bool = True,
    plotted_only: bool = False,
    fields: list[str] | None = None,
) -> DataFrame:
    """Long table, one row per point: position (0 is the alert itself), time, days
    from the last and from the first element, band and magnitude.

    ZTF points are tagged detection or upper limit; LSST fluxes become
    magnitudes. ``plotted_only`` keeps the bands and errors a plot would show;
    ``fields`` leaves out photometry that is not needed (the columns derived
    from it are left out too). Each alert carries its history, so this is an explode and never a shuffle.
    """
    shape = layout(survey)
    ids = ids if ids is not None else [c for c in shape.key if c in df.columns]
    wanted = [f for f in shape.photometry if fields is None or f in fields or f == shape.time]
    arrays = {f: extract_field(df, f, shape.current, shape.history) for f in wanted}
    zipped = df.select(
        *ids,
        F.element_at(arrays[shape.time], -1).alias("_last"),
        F.element_at(arrays[shape.time], 1).alias("_first"),
        F.arrays_zip(*[a.alias(f) for f, a in arrays.items()]).alias("_points"),
    )
    # The array is never empty; the outer form only spares Spark a test of that.
    points = zipped.select(*ids, "_last", "_first", F.posexplode_outer("_points").alias("pos", "_p")).select(
        *ids,
        "pos",
        F.col(f"_p.{shape.time}").alias("time"),
        (F.col(f"_p.{shape.time}") - F.col("_last")).alias("days_from_last"),
        (F.col(f"_p.{shape.time}") - F.col("_first")).alias("days_from_first"),
        *[F.col(f"_p.{f}").alias(f) for f in wanted if f != shape.time],
    )
    derived = {}
    if survey == "ztf":
        if "fid" in wanted:
            derived["band"] = ztf_band("fid")
        if "magpsf" in wanted:
            derived["tag"] = detection_tag("magpsf", nan_is_missing)
        if {"magpsf", "diffmaglim"} <= set(wanted):
            derived["y"] = detection_value("magpsf", "diffmaglim", nan_is_missing)
        keep = F.col("band").isNotNull() if "band" in derived else F.lit(True)
    else:
        if {"psfFlux", "psfFluxErr"} <= set(wanted):
            derived["mag"], derived["magerr"] = flux_to_mag("psfFlux", "psfFluxErr")
        keep = is_lsst_band("band") if "band" in wanted else F.lit(True)
        keep = keep & has_positive_error("magerr") if "magerr" in derived else keep
    out = points.select("*", *[c.alias(n) for n, c in derived.items()])
    return out.filter(keep) if plotted_only else out


def band_statistics(df: DataFrame, survey: str, ids: list[str] | None = None) -> DataFrame:
    """One row per alert and band: ``n_points``, ``n_shown`` (detections, or points with
    a positive error), and of the shown points ``mag_min`` and the largest finite
    ``magerr_max``. An alert holds its whole light curve, so this needs no shuffle.
    """
    shape = layout(survey)
    ids = ids if ids is not None else [c for c in shape.key if c in df.columns]
    names = ("fid", "magpsf", "sigmapsf") if survey == "ztf" else ("band", "psfFlux", "psfFluxErr")
    zipped = F.arrays_zip(*[extract_field(df, f, shape.current, shape.history).alias(f) for f in names])

    def point(p: Column) -> Column:
        if survey == "ztf":
            band, mag, err = ztf_band(p["fid"]), p["magpsf"].cast("double"), p["sigmapsf"].cast("double")
            shown = ~is_missing(p["magpsf"])
        else:
            (mag, err), band = flux_to_mag(p["psfFlux"], p["psfFluxErr"]), p["band"]
            shown = has_positive_error(err)
        finite = shown & (F.abs(err) < float("inf"))  # NaN is above every number
        return F.struct(
            band.alias("band"), F.when(shown, 1).otherwise(0).cast("bigint").alias("shown"),
            F.when(shown, mag).alias("mag"), F.when(finite, err).alias("err"),
        )

    def of_band(points: Column, band: Column) -> Column:
        nothing, none = F.lit(0).cast("bigint"), F.lit(None).cast("double")
        start = F.struct(nothing.alias("n"), nothing.alias("shown"), none.alias("mag"), none.alias("err"))

        def add(total: Column, p: Column) -> Column:
            return F.struct(
                (total["n"] + 1).alias("n"), (total["shown"] + p["shown"]).alias("shown"),
                F.least(total["mag"], p["mag"]).alias("mag"), F.greatest(total["err"], p["err"]).alias("err"),
            )

        same = F.filter(points, lambda p: p["band"].eqNullSafe(band))
        return F.struct(band.alias("band"), F.aggregate(same, start, add).alias("of"))

    # An array of one element, so that a lambda names the points, worked out once an alert.
    per_band = F.transform(F.array(F.transform(zipped, point)), lambda ps: F.transform(F.array_distinct(F.transform(ps, lambda p: p["band"])), lambda b: of_band(ps, b)))
    rows = df.select(*ids, F.explode(F.element_at(per_band, 1)).alias("_b"))
    return rows.select(
        *ids, "_b.band", F.col("_b.of.n").alias("n_points"), F.col("_b.of.shown").alias("n_shown"),
        F.col("_b.of.mag").alias("mag_min"), F.col("_b.of.err").alias("magerr_max"),
    )


def bands_present(points: DataFrame, ids: list[str]) -> DataFrame:
    """Distinct bands of each light curve, from its points in rows."""
    return points.select(*ids, "band").distinct()


def bands_of(alert_bands: Column, history_bands: Column) -> Column:
    """Distinct bands of the light curve one row holds: no rows are made, nothing is shuffled."""
    return F.array_distinct(F.concat(F.array(alert_bands), F.coalesce(history_bands, F.array().cast("array<string>"))))


def object_history(
    spark: SparkSession,
    archive_path: str,
    object_ids: list | DataFrame,
    columns: list[str],
    id_column: str = "objectId",
) -> DataFrame:
    """Chosen columns of all archived points of some objects, upper limits included.

    A list of ids becomes a filter and reaches the Parquet scan; a table of ids
    is joined. If the archive has an index (``index_objects``), only files that
    hold some of the objects are opened.
    """
    archive = read_objects(spark, archive_path, id_column, object_ids)
    if isinstance(object_ids, DataFrame):
        # Broadcast when small: an object with very many rows then never shuffles.
        found = archive.join(broadcast_if_small(object_ids.select(id_column).distinct()), id_column, "left_semi")
    else:
        found = archive.filter(F.col(id_column).isin(*object_ids))
    return found.select(id_column, *[c for c in columns if c != id_column])
