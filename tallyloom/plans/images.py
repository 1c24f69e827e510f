"""Queries on the pixel table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import pixels
from tallyloom.operators.aggregate import binned_stats
from tallyloom.plans import views
from tallyloom.plans.registry import Tables, query

c = F.col
_PX = f"WITH {views.PIXELS}"
_LONG = """long AS (SELECT image_id, 'r' AS band, r AS bin FROM pixels UNION ALL SELECT image_id, 'g', g FROM pixels
  UNION ALL SELECT image_id, 'b', b FROM pixels)"""
_HIST = f"{_LONG}, hist AS (SELECT image_id, band, bin, count(*) AS n FROM long GROUP BY 1, 2, 3)"


def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({x: F.round(x, digits) for x in cols})


@query("pixel_window", f"{_PX} SELECT image_id, x, y, r, g, b FROM pixels WHERE x < 10 AND y < 10")
def pixel_window(t: Tables) -> DataFrame:
    return pixels.pixel_window(views.pixels(t), 10, 10)


@query(
    "rgb_histogram",
    f"""{_PX}, {_HIST}, f AS (SELECT image_id, band, CAST(i AS INTEGER) AS bin FROM (SELECT DISTINCT image_id, band FROM hist), range(256) r(i))
        SELECT f.image_id, f.band, f.bin, coalesce(n, 0) AS n FROM f LEFT JOIN hist USING (image_id, band, bin)""",
)
def rgb_histogram(t: Tables) -> DataFrame:
    return pixels.rgb_histogram(views.pixels(t))


@query(
    "top_intensities",
    f"""{_PX}, {_HIST}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY image_id, band ORDER BY n DESC, bin) AS INTEGER) AS rank FROM hist)
        SELECT * FROM r WHERE rank <= 20""",
)
def top_intensities(t: Tables) -> DataFrame:
    return pixels.top_intensities(views.pixels(t))


@query(
    "image_stats",
    f"""{_PX}, {_HIST}, k AS (SELECT image_id, r, g, b, row_number() OVER (PARTITION BY image_id ORDER BY count(*) DESC, r, g, b) AS rn
          FROM pixels GROUP BY 1, 2, 3, 4),
        s AS (SELECT image_id, max(x) + 1 AS width, max(y) + 1 AS height, count(*) AS pixels, round(avg(r), 6) AS mean_r,
          round(avg(g), 6) AS mean_g, round(avg(b), 6) AS mean_b FROM pixels GROUP BY 1),
        d AS (SELECT image_id, sum(n * n) AS sq, sum(n) AS total FROM hist GROUP BY 1)
        SELECT s.*, format('#{{:02x}}{{:02x}}{{:02x}}', k.r, k.g, k.b) AS dominant,
          round(sqrt(sq / 768 - (total / 768) * (total / 768)), 6) AS diversity
        FROM s JOIN k ON s.image_id = k.image_id AND rn = 1 JOIN d ON d.image_id = s.image_id""",
)
def image_stats(t: Tables) -> DataFrame:
    return _round(pixels.image_stats(views.pixels(t)), 6, "mean_r", "mean_g", "mean_b", "diversity")


_GREY = "floor(0.299 * r + 0.587 * g + 0.114 * b + 0.5)"
_LEVEL = f"level AS (SELECT image_id, round(avg(CAST({_GREY} AS DOUBLE)), 6) AS brightness FROM pixels GROUP BY 1)"


@query(
    "day_night",
    f"{_PX}, {_LEVEL} SELECT image_id, brightness, CASE WHEN brightness < 127 THEN 'night' ELSE 'day' END AS time FROM level",
)
def day_night(t: Tables) -> DataFrame:
    return _round(pixels.day_night(views.pixels(t), 127), 6, "brightness")


def _by_supplier(t: Tables) -> DataFrame:
    """A pixel table with one image per supplier, so that images can have a country."""
    return t.lineitem.select(
        c("l_suppkey").alias("image_id"),
        (c("l_orderkey") % 64).alias("x"),
        (c("l_partkey") % 64).alias("y"),
        ((c("l_orderkey") * 7) % 256).cast("int").alias("r"),
        ((c("l_partkey") * 11) % 256).cast("int").alias("g"),
        ((c("l_suppkey") * 17) % 256).cast("int").alias("b"),
    )


@query(
    "night_by_country",
    """WITH p AS (SELECT l_suppkey AS image_id, l_orderkey * 7 % 256 AS r, l_partkey * 11 % 256 AS g, l_suppkey * 17 % 256 AS b FROM lineitem),
         n AS (SELECT image_id FROM p GROUP BY 1 HAVING avg(floor(0.299 * r + 0.587 * g + 0.114 * b + 0.5)) < 127),
         k AS (SELECT n_name AS country, count(*) AS n FROM n JOIN supplier ON s_suppkey = image_id JOIN nation ON n_nationkey = s_nationkey
           GROUP BY 1)
       SELECT country, n, country = (SELECT country FROM k ORDER BY n DESC, country LIMIT 1) AS winner FROM k""",
)
def night_by_country(t: Tables) -> DataFrame:
    meta = t.supplier.join(t.nation, c("s_nationkey") == c("n_nationkey"))
    meta = meta.select(c("s_suppkey").alias("image_id"), c("n_name").alias("country"))
    return pixels.night_by_country(_by_supplier(t), meta, 127)


@query(
    "hist_equalise",
    f"""{_PX}, {_HIST}, q AS (SELECT *, sum(n) OVER (PARTITION BY image_id, band ORDER BY bin) AS cdf,
          sum(n) OVER (PARTITION BY image_id, band) AS total FROM hist),
        m AS (SELECT *, min(cdf) OVER (PARTITION BY image_id, band) AS low FROM q)
        SELECT image_id, band, bin, n, CAST(floor((cdf - low) / (total - low) * 255 + 0.5) AS INTEGER) AS equalised FROM m""",
)
def hist_equalise(t: Tables) -> DataFrame:
    return pixels.equalise(views.pixels(t))


@query(
    "resize_block_mean",
    f"""{_PX} SELECT image_id, CAST(floor(x * 16 / 64) AS BIGINT) AS x, CAST(floor(y * 16 / 64) AS BIGINT) AS y, round(avg(r), 6) AS r,
          round(avg(g), 6) AS g, round(avg(b), 6) AS b FROM pixels GROUP BY ALL""",
)
def resize_block_mean(t: Tables) -> DataFrame:
    return _round(pixels.resize(views.pixels(t), 64, 64, 16, 16), 6, "r", "g", "b")


@query(
    "resize_any",
    f"""{_PX}, part AS (SELECT * FROM pixels WHERE x < 50 + 3 * image_id AND y < 30 + 8 * image_id),
        sizes AS (SELECT image_id, max(x) + 1 AS width, max(y) + 1 AS height FROM part GROUP BY 1),
        wide AS (SELECT p.*, width, height, unnest(range(CAST(floor(x * 100 / width) AS BIGINT), CAST(ceil((x + 1) * 100 / width) AS BIGINT))) AS nx
          FROM part p JOIN sizes USING (image_id)),
        cells AS (SELECT *, unnest(range(CAST(floor(y * 40 / height) AS BIGINT), CAST(ceil((y + 1) * 40 / height) AS BIGINT))) AS ny FROM wide),
        w AS (SELECT *, (least((x + 1) * 100, (nx + 1) * width) - greatest(x * 100, nx * width))
          * (least((y + 1) * 40, (ny + 1) * height) - greatest(y * 40, ny * height)) AS area FROM cells)
        SELECT image_id, nx AS x, ny AS y, round(sum(r * area) / sum(area), 9) AS r, round(sum(g * area) / sum(area), 9) AS g,
          round(sum(b * area) / sum(area), 9) AS b FROM w GROUP BY ALL""",
)
def resize_any(t: Tables) -> DataFrame:
    """Images of different sizes, all brought to 100 x 40: wider, and lower for some."""
    px = views.pixels(t).where(F.expr("x < 50 + 3 * image_id AND y < 30 + 8 * image_id"))
    return _round(pixels.resize_to(px, pixels.image_sizes(px), 100, 40), 9, "r", "g", "b")


@query(
    "intensity_extremes",
    f"""{_PX}, {_LEVEL} SELECT (SELECT image_id FROM level ORDER BY brightness DESC, image_id LIMIT 1) AS brightest,
          (SELECT image_id FROM level ORDER BY brightness, image_id LIMIT 1) AS darkest""",
)
def intensity_extremes(t: Tables) -> DataFrame:
    return pixels.intensity_extremes(views.pixels(t))


@query(
    "intensity_grid",
    f"""{_PX} SELECT image_id, CAST(floor(x / 4) AS BIGINT) AS x, CAST(floor(y / 4) AS BIGINT) AS y, round(avg(r), 6) AS r,
          round(avg(g), 6) AS g, round(avg(b), 6) AS b FROM pixels GROUP BY ALL""",
)
def intensity_grid(t: Tables) -> DataFrame:
    return _round(pixels.intensity_grid(views.pixels(t), 4), 6, "r", "g", "b")


_DIST = ", ".join(
    f"(r - {r}) * (r - {r}) + (g - {g}) * (g - {g}) + (b - {b}) * (b - {b}) AS d{i}" for i, (r, g, b) in enumerate(views.CENTRES)
)


@query(
    "segment_pixels",
    f"""{_PX}, d AS (SELECT *, {_DIST} FROM pixels), m AS (SELECT *, least(d0, d1, d2, d3) AS d FROM d)
        SELECT image_id, x, y, CASE WHEN d = d0 THEN 0 WHEN d = d1 THEN 255 WHEN d = d2 THEN 0 ELSE 128 END AS r,
          CASE WHEN d = d0 OR d = d1 THEN 0 WHEN d = d2 THEN 255 ELSE 128 END AS g,
          CASE WHEN d = d0 OR d = d1 OR d = d2 THEN 0 ELSE 255 END AS b FROM m""",
)
def segment_pixels(t: Tables) -> DataFrame:
    return pixels.segment(views.pixels(t), views.CENTRES)


@query(
    "binned_stats",
    f"""{_PX}, {_LONG} SELECT image_id, band, round(avg(bin), 6) AS mean, round(var_pop(bin), 4) AS variance, round(stddev_pop(bin), 6) AS std
        FROM long GROUP BY 1, 2""",
)
def binned(t: Tables) -> DataFrame:
    stats = binned_stats(pixels.rgb_histogram(views.pixels(t)), "bin", "n", ["image_id", "band"])
    return _round(_round(stats, 6, "mean", "std"), 4, "variance")
