"""Tables behind charts and maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import wkt_lat, wkt_lon
from tallyloom.sources.generate import unit_hash


def scatter_feed(df: DataFrame, id_col: str, x: str, y: str, group: str, n: int, seed: int = 0) -> DataFrame:
    """A repeatable sample of at most ``n`` points ``x, y, group``, chosen by a hash of the id."""
    draw = unit_hash(F.col(id_col), seed=seed)
    points = df.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(group).alias("group"), id_col, draw.alias("_u"))
    return points.orderBy("_u", id_col).limit(n).drop("_u")


def marker_feed(df: DataFrame, id_col: str, label: str, wkt: str) -> DataFrame:
    """``id, label, lat, lon, popup`` for a map."""
    link = F.concat(F.lit("<a href='#"), F.col(id_col).cast("string"), F.lit("'>"), F.col(label), F.lit("</a>"))
    return df.select(
        F.col(id_col).alias("id"),
        F.col(label).alias("label"),
        wkt_lat(F.col(wkt)).alias("lat"),
        wkt_lon(F.col(wkt)).alias("lon"),
        link.alias("popup"),
    )
