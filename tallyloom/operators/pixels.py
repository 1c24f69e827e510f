"""Images as pixel tables ``image_id, x, y, r, g, b``.

Most results come from counts of equal colours or equal intensities, which are far smaller than the pixels
and are added up before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.colour import grey, hex_colour, to_byte

_BANDS = ("r", "g", "b")


def pixel_window(px: DataFrame, width: int, height: int) -> DataFrame:
    """The pixels of the upper left rectangle."""
    return px.where((F.col("x") < width) & (F.col("y") < height))


def colour_counts(px: DataFrame) -> DataFrame:
    """``image_id, r, g, b, n``: pixels of each colour."""
    return px.groupBy("image_id", *_BANDS).agg(F.count("*").alias("n"))


def rgb_histogram(px: DataFrame, empty_bins: bool = True) -> DataFrame:
    """``image_id, band, bin, n`` with all 256 bins of each band."""
    long = px.select("image_id", *_BANDS).unpivot("image_id", list(_BANDS), "band", "bin")
    counts = long.groupBy("image_id", "band", "bin").agg(F.count("*").alias("n"))
    if not empty_bins:
        return counts
    frame = counts.select("image_id", "band").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(255))))
    return frame.join(counts, ["image_id", "band", "bin"], "left").fillna(0, ["n"])


def top_intensities(px: DataFrame, n: int = 20) -> DataFrame:
    """The n most frequent intensities of each band (ties: darker first)."""
    rank = F.row_number().over(W.partitionBy("image_id", "band").orderBy(F.desc("n"), "bin"))
    return rgb_histogram(px, empty_bins=False).withColumn("rank", rank).where(F.col("rank") <= n)


def image_stats(px: DataFrame) -> DataFrame:
    """Size, pixels, mean per band, dominant colour (ties: smallest) and diversity of each image.

    Diversity is the population deviation of the 3 × 256 histogram counts.
    """
    colours = colour_counts(px)
    best = F.min(F.struct((-F.col("n")).alias("n"), *_BANDS))
    totals = colours.groupBy("image_id").agg(
        F.sum("n").alias("pixels"),
        *[(F.sum(F.col(b) * F.col("n")) / F.sum("n")).alias(f"mean_{b}") for b in _BANDS],
        best.alias("_best"),
    )
    size = px.groupBy("image_id").agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"))
    levels = rgb_histogram(px, empty_bins=False).groupBy("image_id").agg(F.sum(F.col("n") * F.col("n")).alias("_sq"))
    mean = F.col("pixels") * 3 / F.lit(768.0)
    return (
        totals.join(size, "image_id")
        .join(levels, "image_id")
        .select(
            "image_id",
            "width",
            "height",
            "pixels",
            *[f"mean_{b}" for b in _BANDS],
            hex_colour(F.col("_best.r"), F.col("_best.g"), F.col("_best.b")).alias("dominant"),
            F.sqrt(F.col("_sq") / F.lit(768.0) - mean * mean).alias("diversity"),
        )
    )


def greyscale(px: DataFrame) -> DataFrame:
    """``image_id, x, y, grey``."""
    return px.select("image_id", "x", "y", grey(*[F.col(b) for b in _BANDS]).alias("grey"))


def day_night(px: DataFrame, threshold: float = 60) -> DataFrame:
    """``image_id, brightness, time``: night if the mean grey level lies under the threshold."""
    level = greyscale(px).groupBy("image_id").agg(F.avg("grey").alias("brightness"))
    return level.withColumn("time", F.when(F.col("brightness") < threshold, "night").otherwise("day"))


def night_by_country(px: DataFrame, meta: DataFrame, threshold: float = 60) -> DataFrame:
    """``country, n, winner``: night images per country, the country with most of them marked (ties: by name)."""
    night = day_night(px, threshold).where("time = 'night'").join(meta.select("image_id", "country"), "image_id")
    counts = night.groupBy("country").agg(F.count("*").alias("n"))
    first = counts.agg(F.min_by("country", F.struct(-F.col("n"), "country"))).scalar()
    return counts.withColumn("winner", F.col("country").eqNullSafe(first))


def equalise(px: DataFrame) -> DataFrame:
    """Histogram equalisation: ``image_id, band, bin, n, equalised`` – the new level of each old one.

    The running count stays within one image and band, 256 bins at most.
    """
    hist = rgb_histogram(px, empty_bins=False)
    bins = W.partitionBy("image_id", "band")
    upto = F.sum("n").over(bins.orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
    rows = hist.withColumn("_cdf", upto).withColumn("_all", F.sum("n").over(bins)).withColumn("_low", F.min("_cdf").over(bins))
    span = F.col("_all") - F.col("_low")
    level = F.floor((F.col("_cdf") - F.col("_low")) / span * 255 + 0.5)
    return rows.select("image_id", "band", "bin", "n", F.when(span > 0, level).otherwise(F.col("bin")).cast("int").alias("equalised"))


def apply_levels(px: DataFrame, levels: DataFrame) -> DataFrame:
    """Replace band values by equalised ones (at most 768 rows per image are joined)."""
    packed = levels.groupBy("image_id").agg(
        *[
            F.map_from_entries(F.collect_list(F.when(F.col("band") == b, F.struct("bin", "equalised")))).alias(f"_{b}")
            for b in _BANDS
        ]
    )
    joined = px.join(packed, "image_id")
    return joined.select("image_id", "x", "y", *[F.col(f"_{b}")[F.col(b)].alias(b) for b in _BANDS])


def image_sizes(px: DataFrame) -> DataFrame:
    """``image_id, width, height`` as far as there are pixels."""
    return px.groupBy("image_id").agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"))


def resize_to(px: DataFrame, sizes: DataFrame, new_width: int, new_height: int) -> DataFrame:
    """Bring images of any size (``image_id, width, height``) to one size, larger or smaller.

    Each new pixel is the mean of the old ones it covers, weighted by the area they share, so an image without missing pixels
    has none afterwards. Areas are whole numbers: a new pixel is ``width`` wide where an old one is ``new_width`` wide. An old
    pixel gives one row for each new one it touches; rows of one place are averaged; null levels carry no weight.
    """
    placed = px.join(sizes.select("image_id", F.col("width").cast("long"), F.col("height").cast("long")), "image_id")

    def touched(at: str, size: str, new: int) -> Column:
        start, stop = F.col(at) * new, (F.col(at) + 1) * new
        places = F.sequence(F.floor(start / F.col(size)), F.ceil(stop / F.col(size)) - 1)
        share = lambda k: F.least(stop, (k + 1) * F.col(size)) - F.greatest(start, k * F.col(size))
        return F.transform(places, lambda k: F.struct(k.alias("at"), share(k).alias("w")))

    wide = placed.where("x >= 0 AND x < width AND y >= 0 AND y < height").select("image_id", *_BANDS, F.explode(touched("x", "width", new_width)).alias("_x"), "y", "height")
    both = wide.select("image_id", *_BANDS, "_x", F.explode(touched("y", "height", new_height)).alias("_y"))
    w = F.col("_x.w") * F.col("_y.w")
    means = [F.try_divide(F.sum(F.col(b) * w), F.sum(F.when(F.col(b).isNotNull(), w))).alias(b) for b in _BANDS]
    return both.groupBy("image_id", F.col("_x.at").alias("x"), F.col("_y.at").alias("y")).agg(*means)


def resize(px: DataFrame, width: int, height: int, new_width: int, new_height: int) -> DataFrame:
    """The same for images of one known size."""
    sizes = px.select("image_id").distinct().select("image_id", F.lit(width).alias("width"), F.lit(height).alias("height"))
    return resize_to(px, sizes, new_width, new_height)


def intensity_grid(px: DataFrame, block: int) -> DataFrame:
    """Mean of each band over square blocks: ``image_id, x, y, r, g, b``."""
    x, y = F.floor(F.col("x") / block).alias("x"), F.floor(F.col("y") / block).alias("y")
    return px.groupBy("image_id", x, y).agg(*[F.avg(b).alias(b) for b in _BANDS])


def intensity_extremes(px: DataFrame) -> DataFrame:
    """The brightest and the darkest image by mean grey level (ties: smallest id)."""
    level = day_night(px).select("image_id", "brightness")
    return level.agg(
        F.min_by("image_id", F.struct(-F.col("brightness"), "image_id")).alias("brightest"),
        F.min_by("image_id", F.struct("brightness", "image_id")).alias("darkest"),
    )


def nearest_colour(centres: Sequence[Sequence[float]]):
    """Index of the nearest of a few fixed colours, as a Column (ties: first one)."""
    gaps = [
        F.struct(
            sum((F.col(b) - F.lit(float(v))) * (F.col(b) - F.lit(float(v))) for b, v in zip(_BANDS, centre)).alias("d"),
            F.lit(i).alias("i"),
        )
        for i, centre in enumerate(centres)
    ]
    return F.array_min(F.array(*gaps))["i"]


def segment(px: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Replace each pixel by its nearest centre, clipped to whole levels."""
    levels = F.array(*[F.array(*[to_byte(F.lit(float(v))) for v in centre]) for centre in centres])
    chosen = px.withColumn("_c", F.element_at(levels, nearest_colour(centres) + 1))
    return chosen.select("image_id", "x", "y", *[F.col("_c")[i].alias(b) for i, b in enumerate(_BANDS)])
