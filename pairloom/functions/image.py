"""Image checks and geometry (F9, F10, P8): arithmetic on columns; decoding is injected."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

MIN_BYTES = 5000
MAX_PIXELS = 89_478_484
FORMATS = ("JPEG", "JPG", "PNG", "WEBP")
SIDE = 224
#: Status bits over 8.
ERROR, BAD_FORMAT, TOO_BIG, TOO_SMALL = 1, 2, 4, 8


def status(n_bytes: str | Column, width: str | Column, height: str | Column, fmt: str | Column, failed: str | Column) -> Column:
    """2 if all is well, else 8 plus error bits.

    An image that can't be decoded has only its size and the error known; the format isn't
    tested when the image is too big.
    """
    small = F.when(col(n_bytes) < MIN_BYTES, TOO_SMALL).otherwise(0)
    bad = F.coalesce(col(failed), F.lit(False)) | col(width).isNull() | col(height).isNull()
    big = col(width).cast("long") * col(height) > MAX_PIXELS
    unknown = ~F.coalesce(F.upper(col(fmt)).isin(*FORMATS), F.lit(False))
    rest = F.when(bad, ERROR).when(big, TOO_BIG).when(unknown, BAD_FORMAT).otherwise(0)
    code = 8 + small + rest
    return F.when(code == 8, 2).otherwise(code).cast("int")


def error_bits(code: str | Column) -> Column:
    """Struct of the flags in a status over 8."""
    has = lambda bit: (col(code) > 8) & ((col(code) - 8).bitwiseAND(F.lit(bit)) > 0)
    return F.struct(has(ERROR).alias("error"), has(BAD_FORMAT).alias("bad_format"), has(TOO_BIG).alias("too_big"), has(TOO_SMALL).alias("too_small"))


def crop(width: str | Column, height: str | Column, side: int = SIDE) -> Column:
    """struct of the resized width and height and the crop's corner.

    Only images whose sides are both over ``side`` shrink; the shorter becomes ``side``,
    the longer is rounded half to even, and the centre is cropped where there is more.
    """
    w, h = col(width), col(height)
    shrink = (w > side) & (h > side)
    short = F.least(w, h)
    new = lambda x: F.when(shrink, F.bround(x * side / short).cast("int")).otherwise(x)
    at = lambda x: F.greatest(F.floor((new(x) - side) / 2), F.lit(0)).cast("int")
    return F.struct(new(w).alias("width"), new(h).alias("height"), at(w).alias("left"), at(h).alias("top"))


#: The bytes that image files begin with, in hex; a RIFF file tells its kind
#: behind its size.
HEADS = ("FFD8FF", "89504E470D0A1A0A", "474946383761", "474946383961")
RIFF, WEBP = "52494646", "57454250"


def opens(content: str | Column) -> Column:
    """Whether the bytes begin as an image that a reader opens; null and empty do not."""
    head = F.hex(F.substring(content, 1, 12))
    known = F.lit(False)
    for h in HEADS:
        known = known | head.startswith(h)
    return F.coalesce(known | (head.startswith(RIFF) & head.endswith(WEBP)), F.lit(False))
