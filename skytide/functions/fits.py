"""Primary image of a FITS file as Arrow functions (public FITS standard)."""

from __future__ import annotations

import gzip
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 2880
CARD = 80
GZIP_MAGIC = b"\x1f\x8b"
PIXEL_TYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}

IMAGE_TYPE = T.StructType(
    [
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("pixels", T.ArrayType(T.DoubleType())),
        T.StructField("error", T.StringType()),
    ]
)
STATS_TYPE = T.StructType(
    [
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("n_finite", T.IntegerType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


def unzip(stamp: bytes) -> bytes:
    return gzip.decompress(stamp)


def read_image(data: bytes) -> np.ndarray:
    """The 2-D pixels of the primary unit, scaled, in native byte order."""
    cards: dict[str, str] = {}
    at, done = 0, False
    while not done:
        block = data[at : at + BLOCK]
        if len(block) < BLOCK:
            raise ValueError("FITS header is cut short")
        for i in range(0, BLOCK, CARD):
            card = block[i : i + CARD].decode("ascii")
            word = card[:8].strip()
            if word == "END":
                done = True
                break
            if card[8:10] == "= ":
                cards[word] = card[10:].split("/")[0].strip()
        at += BLOCK
    # A missing SIMPLE card is let pass, as readers of alert stamps do.
    if cards.get("SIMPLE", "T") != "T" or int(cards.get("NAXIS", 0)) != 2:
        raise ValueError("not a two-dimensional FITS image")
    width, height = int(cards["NAXIS1"]), int(cards["NAXIS2"])
    kind = np.dtype(PIXEL_TYPES[int(cards["BITPIX"])])
    pixels = np.frombuffer(data, dtype=kind, count=width * height, offset=at)
    scale, zero = float(cards.get("BSCALE", 1)), float(cards.get("BZERO", 0))
    if kind.kind != "f" or (scale, zero) != (1.0, 0.0):
        raw = pixels.astype(np.float64)
        if kind.kind != "f" and "BLANK" in cards:
            raw[pixels == int(cards["BLANK"])] = np.nan
        pixels = raw * scale + zero
    # Single precision only where the file has it: integers keep all digits.
    return pixels.reshape(height, width).astype(np.float32 if pixels.dtype == np.dtype(">f4") else np.float64)


def write_image(pixels: np.ndarray, double: bool = False) -> bytes:
    """A minimal FITS file of single or double precision."""
    height, width = pixels.shape
    lines = ["SIMPLE  =                    T", f"BITPIX  = {-64 if double else -32:20d}", f"NAXIS   = {2:20d}"]
    lines += [f"NAXIS1  = {width:20d}", f"NAXIS2  = {height:20d}", "END"]
    head = "".join(line.ljust(CARD) for line in lines).encode()
    body = np.ascontiguousarray(pixels, dtype=">f8" if double else ">f4").tobytes()
    return head.ljust(BLOCK, b" ") + body.ljust(-(-len(body) // BLOCK) * BLOCK, b"\0")


def _load(stamp: bytes, clean: bool, flip: bool) -> np.ndarray:
    image = read_image(unzip(stamp) if stamp[:2] == GZIP_MAGIC else stamp)
    if clean:
        image = np.nan_to_num(image)
    return image[::-1] if flip else image


_BAD = (ValueError, KeyError, OSError, EOFError, zlib.error)


def image_of(clean: bool = False, display_orientation: bool = False, fail_fast: bool = False):
    """Arrow function: stamp bytes (gzip or plain) to ``IMAGE_TYPE``.

    ``clean`` replaces NaN by 0 and infinities by the largest finite numbers of
    the image's own precision;
    ``display_orientation`` flips rows. A bad stamp gives an error text, or
    raises with ``fail_fast``.
    """

    @F.arrow_udf(IMAGE_TYPE)
    def decode(stamps: pa.Array) -> pa.Array:
        heights, widths, errors, sizes, flat = [], [], [], [0], []
        for stamp in stamps:
            body = stamp.as_py()
            image, error = None, None
            if body is not None:
                try:
                    image = _load(body, clean, display_orientation)
                except _BAD as err:
                    if fail_fast:
                        raise
                    error = f"{type(err).__name__}: {err}"
            heights.append(None if image is None else image.shape[0])
            widths.append(None if image is None else image.shape[1])
            errors.append(error)
            sizes.append(sizes[-1] + (0 if image is None else image.size))
            if image is not None:
                flat.append(image.ravel().astype(np.float64))
        values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.float64))
        offsets = pa.array(sizes, pa.int32(), mask=np.array([h is None for h in heights] + [False]))
        pixels = pa.ListArray.from_arrays(offsets, values)
        return pa.StructArray.from_arrays(
            [pa.array(heights, pa.int32()), pa.array(widths, pa.int32()), pixels, pa.array(errors, pa.string())],
            names=IMAGE_TYPE.fieldNames(),
        )

    return decode.asNondeterministic()


def stats_of(clean: bool = False):
    """Arrow function: stamp bytes to pixel statistics; no pixel leaves the task.

    Statistics are over finite pixels, after cleaning if asked for.
    """

    @F.arrow_udf(STATS_TYPE)
    def measure(stamps: pa.Array) -> pa.Array:
        rows = []
        for stamp in stamps:
            body = stamp.as_py()
            row = dict.fromkeys(STATS_TYPE.fieldNames())
            if body is not None:
                try:
                    image = _load(body, clean, False)
                    good = image[np.isfinite(image)].astype(np.float64)
                    row.update(height=image.shape[0], width=image.shape[1], n_finite=good.size)
                    if good.size:
                        row.update(min=float(good.min()), max=float(good.max()), mean=float(good.mean()))
                except _BAD as err:
                    row["error"] = f"{type(err).__name__}: {err}"
            rows.append(row)
        kinds = [pa.int32()] * 3 + [pa.float64()] * 3 + [pa.string()]
        return pa.array(rows, pa.struct(list(zip(STATS_TYPE.fieldNames(), kinds))))

    return measure.asNondeterministic()


@F.arrow_udf(T.BinaryType())
def uncompressed(stamps: pa.Array) -> pa.Array:
    """Plain FITS bytes of a gzip stamp; plain stamps pass through."""
    plain = [None if b is None else unzip(b) if b[:2] == GZIP_MAGIC else b for b in stamps.to_pylist()]
    return pa.array(plain, pa.binary())
