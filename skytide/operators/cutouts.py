"""Image cutouts of alerts as rows, pixels and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytide.functions import fits
from skytide.naming import layout
from skytide.sources.object_index import read_objects

# The cutouts of an alert, in display order.
KINDS = ("Science", "Template", "Difference")


def cutouts_long(df: DataFrame, survey: str, ids: list[str] | None = None, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """One row per alert and cutout kind; ZTF stamps are taken out of their struct."""
    shape = layout(survey)
    ids = ids if ids is not None else [c for c in shape.key if c in df.columns]
    unknown = [k for k in kinds if k not in KINDS]
    if unknown:
        raise ValueError(f"unknown cutout kind {unknown}")

    def stamp(kind):
        nested = isinstance(df.schema[f"cutout{kind}"].dataType, T.StructType)
        return F.col(f"cutout{kind}.stampData" if nested else f"cutout{kind}")

    rows = [F.struct(F.lit(k).alias("kind"), stamp(k).alias("stamp")) for k in kinds]
    return df.select(*ids, F.explode(F.array(*rows)).alias("_c")).select(*ids, "_c.kind", "_c.stamp")


def decode_cutouts(df: DataFrame, stamp: str = "stamp", clean: bool = False, display_orientation: bool = False,
                   fail_fast: bool = False) -> DataFrame:
    """Replace stamp bytes by ``height``, ``width``, ``pixels`` and ``error``.

    Filter first: decoding is the costly step.
    """
    image = fits.image_of(clean, display_orientation, fail_fast)
    others = [c for c in df.columns if c != stamp]
    return df.withColumn("_image", image(F.col(stamp))).select(*others, "_image.*")


def cutout_stats(df: DataFrame, stamp: str = "stamp", clean: bool = False) -> DataFrame:
    """Per-stamp size, finite count, min, max and mean."""
    others = [c for c in df.columns if c != stamp]
    return df.withColumn("_stats", fits.stats_of(clean)(F.col(stamp))).select(*others, "_stats.*")


def plain_fits(df: DataFrame, stamp: str = "stamp", name: str = "fits") -> DataFrame:
    return df.withColumn(name, fits.uncompressed(F.col(stamp)))


def object_cutout(spark: SparkSession, archive_path: str, key: dict, kind: str, survey: str,
                  display_orientation: bool = True) -> DataFrame:
    """One kind of cutout of the archived alerts matching ``key``, decoded and clean; an
    index of the archive by the key's first column spares files that cannot match."""
    first, sought = next(iter(key.items()))
    found = read_objects(spark, archive_path, first, [sought])
    for column, value in key.items():
        found = found.filter(F.col(column) == value)
    return decode_cutouts(
        cutouts_long(found, survey, kinds=(kind,)), clean=True, display_orientation=display_orientation
    )
