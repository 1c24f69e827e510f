"""Image files through Spark's ``image`` and ``binaryFile`` sources."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# OpenCV type codes used by the image source, as number of 8-bit bands.
_MODES = {0: "L", 16: "RGB", 24: "RGBA"}


def orientation(width: Column, height: Column) -> Column:
    """``landscape``, ``portrait`` or ``square``."""
    return F.when(width > height, "landscape").when(width < height, "portrait").otherwise("square")


def size_class(width: Column, height: Column, small: int = 256, medium: int = 1024) -> Column:
    """``thumbnail`` up to ``small`` pixels on the longer side, ``medium``, else ``large``."""
    side = F.greatest(width, height)
    return F.when(side <= small, "thumbnail").when(side <= medium, "medium").otherwise("large")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images: ``origin, name, format, width, height, bands, mode, data`` (data is BGR, row by row)."""
    image = spark.read.format("image").option("dropInvalid", True).load(path).select("image.*")
    code = F.create_map(*[F.lit(v) for pair in _MODES.items() for v in pair])
    return image.select(
        "origin",
        F.element_at(F.split("origin", "/"), -1).alias("name"),
        F.lower(F.regexp_extract("origin", r"\.([^./]+)$", 1)).alias("format"),
        "width",
        "height",
        F.col("nChannels").alias("bands"),
        code[F.col("mode")].alias("mode"),
        "data",
    )


def to_pixels(images: DataFrame, id_col: str = "name") -> DataFrame:
    """One row per pixel: ``image_id, x, y, r, g, b``. Each image is unpacked by NumPy inside its task."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, w, h, n, data in batch.itertuples(index=False):
                bands = np.frombuffer(data, np.uint8).reshape(h, w, n).astype(np.int32)
                blue, green, red = (bands[:, :, i if n >= 3 else 0] for i in range(3))
                y, x = np.divmod(np.arange(w * h), w)
                yield pd.DataFrame(
                    {"image_id": key, "x": x, "y": y, "r": red.ravel(), "g": green.ravel(), "b": blue.ravel()}
                )

    packed = images.select(F.col(id_col).cast("string"), "width", "height", "bands", "data")
    return packed.mapInPandas(unpack, "image_id string, x int, y int, r int, g int, b int")


def image_catalogue(images: DataFrame, meta: DataFrame | None = None, on: str = "name") -> DataFrame:
    """Name, format, size, size class and orientation per image, with metadata (date, camera…) where known."""
    base = images.select(
        "name",
        "format",
        "width",
        "height",
        size_class(F.col("width"), F.col("height")).alias("size"),
        orientation(F.col("width"), F.col("height")).alias("orientation"),
    )
    return base if meta is None else base.join(meta, on, "left")


def larger_than(spark: SparkSession, path: str, kilobytes: float) -> DataFrame:
    """``path, length`` of the files above a size; the contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.where(F.col("length") > int(kilobytes * 1024)).select("path", "length")
