"""Binary header and pixel columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Signature and field offsets of the image header.
PNG_SIGNATURE = "89504E470D0A1A0A"
HEADER_BYTES = 26


def _number(content: Column, start: int, length: int) -> Column:
    return F.conv(F.hex(F.substring(content, start, length)), 16, 10).cast("long")


def png_fields(content: Column) -> dict[str, Column]:
    """Header fields of image bytes; nulls when the signature or length is wrong."""
    good = (F.hex(F.substring(content, 1, 8)) == PNG_SIGNATURE) & (F.length(content) >= HEADER_BYTES)
    return {
        "valid": good,
        "width": F.when(good, _number(content, 17, 4)),
        "height": F.when(good, _number(content, 21, 4)),
        "depth": F.when(good, _number(content, 25, 1)),
        "color_type": F.when(good, _number(content, 26, 1)),
    }


def luminance(r: Column, g: Column, b: Column) -> Column:
    return F.lit(0.2126) * r + F.lit(0.7152) * g + F.lit(0.0722) * b
