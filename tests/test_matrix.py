import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import pixels
from tallyloom.operators.matrix import mat_mul


def table(spark, m, kind):
    r, c = np.nonzero(m)
    return spark.createDataFrame([(int(i), int(j), m[i, j].item()) for i, j in zip(r, c)], f"row long, col long, value {kind}").repartition(3)


@pytest.mark.parametrize("kind", ["long", "double"])
def test_product_with_one_dense_inner_index(spark, kind):
    rng = np.random.default_rng(6)
    a, b = (rng.integers(-5, 6, s) * (rng.random(s) < 0.05) for s in ((70, 40), (40, 90)))
    a[:, 7], b[7] = rng.integers(1, 9, 70), rng.integers(1, 9, 90)
    if kind == "double":
        a, b = a / 8, b / 8
    got = mat_mul(table(spark, a, kind), table(spark, b, kind), block=16)
    assert dict(got.dtypes)["value"] == ("bigint" if kind == "long" else "double")
    out = np.zeros((70, 90))
    rows = got.collect()
    assert len(rows) == 70 * 90
    for r in rows:
        out[r["row"], r["col"]] = r["value"]
    np.testing.assert_array_equal(out, a @ b)


def test_product_of_odd_cells(spark):
    a = spark.createDataFrame([(0, 0, 2), (0, 1, None), (-3, 300, 5), (1, 0, 1), (1, 0, 2)], "row long, col long, value long")
    b = spark.createDataFrame([(0, 5, 3), (1, 5, 9), (300, -1, 4)], "row long, col long, value long")
    got = {(r["row"], r["col"]): r["value"] for r in mat_mul(a, b).collect()}
    assert got == {(0, 5): 6, (-3, -1): 20, (1, 5): 9}
    assert mat_mul(a.limit(0), b).count() == 0


def plain_resize(levels, new_width, new_height):
    height, width = levels.shape
    out = np.zeros((new_height, new_width))
    for y in range(new_height):
        for x in range(new_width):
            total = area = 0.0
            for v in range(height):
                for u in range(width):
                    w = max(0.0, min((x + 1) * width / new_width, u + 1) - max(x * width / new_width, u))
                    h = max(0.0, min((y + 1) * height / new_height, v + 1) - max(y * height / new_height, v))
                    total, area = total + w * h * levels[v, u], area + w * h
            out[y, x] = total / area
    return out


def test_images_of_any_size_become_one_size(spark):
    rng = np.random.default_rng(7)
    images = {1: rng.integers(0, 256, (5, 7)), 2: rng.integers(0, 256, (12, 4)), 3: rng.integers(0, 256, (1, 1))}
    rows = [(i, x, y, int(m[y, x]), 0, None) for i, m in images.items() for y in range(m.shape[0]) for x in range(m.shape[1])]
    px = spark.createDataFrame(rows, "image_id long, x long, y long, r int, g int, b int")
    got = pixels.resize_to(px, pixels.image_sizes(px), 6, 9).toPandas()
    assert len(got) == 3 * 54 and got["b"].isna().all()
    for i, m in images.items():
        mine = got[got["image_id"] == i].sort_values(["y", "x"])["r"].to_numpy().reshape(9, 6)
        np.testing.assert_allclose(mine, plain_resize(m, 6, 9), atol=1e-9)


def test_a_larger_image_has_no_holes(spark):
    px = spark.range(100 * 100).select(F.lit(1).alias("image_id"), (F.col("id") % 100).alias("x"), F.floor(F.col("id") / 100).alias("y"), *[F.lit(9).alias(b) for b in "rgb"])
    got = pixels.resize(px, 100, 100, 256, 256)
    assert got.count() == 256 * 256 and got.agg(F.max("r") - F.min("r")).first()[0] == pytest.approx(0, abs=1e-9)
