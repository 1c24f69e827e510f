import struct
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import pixels
from tallyloom.sources import files, generate, images, tables


def test_missing_cells_are_filled(spark, tmp_path):
    path = tmp_path / "langs.csv"
    path.write_text("# name,year\nSimula,1962\nSwift,\nOdd,x\n")
    df = files.read_table_tolerant(spark, str(path), "name string, year int", fill={"year": 0})
    assert [tuple(r) for r in df.orderBy("name").collect()] == [("Odd", 0), ("Simula", 1962), ("Swift", 0)]


def test_bad_cell_is_an_error_in_strict_mode(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("name,year\nOdd,x\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_table(spark, str(path), "name string, year int").collect()


def test_json_array_is_flattened(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('[{"a": 1, "b": {"c": "x", "d": {"e": 2}}}, {"a": 3, "b": {"c": "y", "d": {"e": 4}}}]')
    df = files.read_json_flat(spark, str(path))
    assert df.columns == ["a", "b.c", "b.d.e"]
    assert [r[2] for r in df.orderBy("a").collect()] == [2, 4]


def test_read_safe(spark, tmp_path):
    df, status = files.read_safe(spark, str(tmp_path / "none.csv"), "a int")
    assert status == "missing" and df.columns == ["a"] and df.isEmpty()
    (tmp_path / "empty.csv").write_text("")
    assert files.read_safe(spark, str(tmp_path / "empty.csv"), "a int")[1] == "empty"
    (tmp_path / "one.csv").write_text("1\n")
    assert files.read_safe(spark, str(tmp_path / "one.csv"), "a int")[1] == "ok"


def test_chunks_are_bounded_and_complete(spark, tmp_path):
    path = tmp_path / "big.txt"
    path.write_text("".join(f"Line {i}: This is test data\n" for i in range(2500)))
    sizes = files.read_chunks(spark, str(path), lambda p: pd.DataFrame({"n": [len(p)]}), "n long", 300).collect()
    assert sum(r["n"] for r in sizes) == 2500 and max(r["n"] for r in sizes) <= 300


def test_tables_and_generators(spark, tmp_path):
    df = files.from_pandas(spark, pd.DataFrame({"id": [1, 2], "titre": ["é", "l’eau"]}), "id int, titre string")
    tables.save_table(df, "books", path=str(tmp_path / "books"))
    tables.append_table(df, "books")
    assert spark.table("books").count() == 4
    assert "books" in {r["name"] for r in tables.list_tables(spark).collect()}
    assert [r["value"] for r in generate.linspace(spark, 0, 1, 5).orderBy("position").collect()] == [0, 0.25, 0.5, 0.75, 1]
    assert generate.zeros(spark, 3, 4).agg(F.count("*"), F.sum("value")).first()[:] == (12, 0.0)
    assert [r[0] for r in generate.int_range(spark, 2, 11, 3).collect()] == [2, 5, 8]
    draws = generate.random_rows(spark, 1000, seed=3, lo=-1, hi=1)
    again = generate.random_rows(spark, 1000, seed=3, lo=-1, hi=1).repartition(7)
    assert draws.exceptAll(again).isEmpty()
    low, high, mean = draws.agg(F.min("value"), F.max("value"), F.avg("value")).first()
    assert -1 <= low and high < 1 and abs(mean) < 0.1


def png(path, width, height, colour):
    rows = b"".join(b"\0" + b"".join(bytes(colour(x, y)) for x in range(width)) for y in range(height))

    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b""))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    where = tmp_path_factory.mktemp("pictures")
    png(where / "small.png", 4, 3, lambda x, y: (10 * x, 20 * y, 200))
    png(where / "dark.png", 3, 4, lambda x, y: (5, 5, 5))
    png(where / "flat.png", 64, 64, lambda x, y: (255, 128, 0))
    return str(where)


def test_images_become_pixels(spark, folder):
    found = images.read_images(spark, folder)
    info = {r["name"]: r for r in found.drop("data").collect()}
    assert (info["small.png"]["width"], info["small.png"]["height"], info["small.png"]["mode"]) == (4, 3, "RGB")
    px = images.to_pixels(found)
    assert px.count() == 12 + 12 + 64 * 64
    got = px.where("image_id = 'small.png' AND x = 2 AND y = 1").first()
    assert (got["r"], got["g"], got["b"]) == (20, 20, 200)
    times = {r["image_id"]: r["time"] for r in pixels.day_night(px).collect()}
    assert times == {"small.png": "night", "dark.png": "night", "flat.png": "day"}


def test_catalogue(spark, folder):
    meta = spark.createDataFrame([("flat.png", "2020")], "name string, date string")
    rows = {r["name"]: r for r in images.image_catalogue(images.read_images(spark, folder), meta).collect()}
    assert rows["small.png"]["orientation"] == "landscape" and rows["dark.png"]["orientation"] == "portrait"
    assert rows["flat.png"]["orientation"] == "square" and rows["flat.png"]["date"] == "2020"
    assert images.larger_than(spark, folder, 0.15).count() >= 1
    assert images.larger_than(spark, folder, 1000).count() == 0


def test_equalised_levels_are_applied(spark, folder):
    px = images.to_pixels(images.read_images(spark, folder))
    out = pixels.apply_levels(px, pixels.equalise(px))
    assert out.count() == px.count()
    small = out.where("image_id = 'small.png'").agg(F.min("r"), F.max("r")).first()
    assert tuple(small) == (0, 255)


def test_primes_by_segments(spark):
    def plain(lo, hi):
        return [n for n in range(max(lo, 2), hi) if all(n % d for d in range(2, int(n**0.5) + 1))]

    for lo, hi in ((0, 2000), (-5, 3), (500_000, 530_000), (10**9, 10**9 + 300), (7, 7), (9, 8)):
        found = sorted(r["value"] for r in generate.primes_between(spark, lo, hi, 3).collect())
        assert found == plain(lo, hi)
    assert generate.count_primes(spark, 0, 1_200_000).first()["primes"] == 92938
