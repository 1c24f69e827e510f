"""Colour arithmetic on red, green and blue columns (0–255)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def grey(r: Column, g: Column, b: Column) -> Column:
    """Luma of a colour, rounded to a whole level; in whole numbers, so that halves round alike everywhere."""
    # The usual luma weights, 0.299, 0.587 and 0.114, in thousandths.
    return F.floor((r * 299 + g * 587 + b * 114 + 500) / 1000).cast("int")


def hex_colour(r: Column, g: Column, b: Column) -> Column:
    """``#rrggbb``, each component rounded up."""
    up = [F.ceil(c).cast("int") for c in (r, g, b)]
    return F.format_string("#%02x%02x%02x", *up)


def rgb_to_hsv(r: Column, g: Column, b: Column) -> Column:
    """``struct<h, s, v>``: hue in degrees [0, 360), saturation and value in [0, 1]."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    span = top - low
    sector = (
        F.when(span == 0, F.lit(0.0))
        .when(top == r, (g - b) / span)
        .when(top == g, (b - r) / span + 2)
        .otherwise((r - g) / span + 4)
    )
    hue = F.when(sector < 0, sector + 6).otherwise(sector) * 60
    return F.struct(
        hue.alias("h"),
        F.when(top == 0, F.lit(0.0)).otherwise(span / top).alias("s"),
        (top / F.lit(255.0)).alias("v"),
    )


def to_byte(col: Column) -> Column:
    """Clip to 0–255 and drop the fraction."""
    return F.floor(F.least(F.greatest(col, F.lit(0.0)), F.lit(255.0))).cast("int")
