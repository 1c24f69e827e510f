import pytest
from pyspark.sql import functions as F

from tallyloom.functions import arrays, numbers, text


def one(spark, value, col):
    return spark.createDataFrame([(value,)], ["v"]).select(col).first()[0]


@pytest.mark.parametrize("value", ["x-ray VISION", "they're bill's", "éCOLE 3rd a1b", "", "  a  "])
def test_title_case_is_pythons(spark, value):
    assert one(spark, value, text.title_case(F.col("v"))) == value.title()


@pytest.mark.parametrize("value", [" a  b\tc\n", "", "a b　c\x1cd", "één twee", " x"])
def test_words_are_pythons(spark, value):
    assert one(spark, value, text.split_text(F.col("v"))) == value.split()
    assert one(spark, value, text.word_count(F.col("v"))) == len(value.split())


def test_text_functions(spark):
    assert one(spark, "Hello,  World! (it's)", text.normalise_text(F.col("v"))) == "hello world its"
    assert one(spark, "a/b/c.tar.gz", text.path_ext(F.col("v"))) == "gz"
    assert one(spark, "a/b/c.tar.gz", text.path_stem(F.col("v"))) == "c.tar"
    assert one(spark, "a/b/c.tar.gz", text.path_depth(F.col("v"))) == 2
    assert one(spark, "http://x.y/p/img.jpg?s=1#t", text.url_basename(F.col("v"))) == "img.jpg"
    assert one(spark, "Line 42: This", text.line_number(F.col("v"))) == 42
    assert one(spark, "no number", text.line_number(F.col("v"))) is None
    assert one(spark, "Point(4.83 45.76)", text.wkt_lat(F.col("v"))) == 45.76
    assert one(spark, "<div><DIV class='a'><div/><divider>", text.tag_count(F.col("v"), "div")) == 3
    assert one(spark, "<div><DIV class='a'><div/><divider>", text.tag_count(F.col("v"), "div", literal=True)) == 2
    assert one(spark, "bad line", text.log_fields(F.col("v"))) is None


def test_numbers(spark):
    primes = spark.range(-3, 3000).where(numbers.is_prime(F.col("id"))).collect()
    assert [r[0] for r in primes] == [n for n in range(2, 3000) if all(n % d for d in range(2, int(n**0.5) + 1))]
    big = spark.createDataFrame([(2147483647,), (2147483649,), (999983 * 1000003,)], ["v"])
    assert [r[0] for r in big.select(numbers.is_prime(F.col("v"))).collect()] == [True, False, False]
    # The largest primes of 64 and 32 bits, squares of primes, and numbers that pass the strong test for small witnesses.
    cases = {9223372036854775783: True, 9223372036854775807: False, 4294967291: True, 3037000493**2: False, 3037000507: True}
    cases |= {1373653: False, 1373639: all(1373639 % d for d in range(2, 1173)), 2047: False, 3215031751: False, 3474749660383: False, 341550071728321: False, 1681: False, 1763: False, -7: False}
    wide = spark.createDataFrame([(n,) for n in cases], "v long").select("v", numbers.is_prime(F.col("v")).alias("p"))
    assert {r["v"]: r["p"] for r in wide.collect()} == cases
    assert one(spark, 1900, numbers.century(F.col("v"))) == 20
    assert one(spark, -5, numbers.decade(F.col("v"))) == "-10s"


def test_arrays(spark):
    assert one(spark, [1, 2, 3], arrays.array_put(F.col("v"), 10, 9)) == [1, 2, 3, 9]
    assert one(spark, [1, 2, 3], arrays.zip_arrays(F.col("v"), F.array(F.lit(10), F.lit(20)), lambda a, b: a + b)) == [11, 22]
    pairs = one(spark, [1, 2], arrays.cross_pairs(F.col("v"), F.array(F.lit("a"), F.lit("b"))))
    assert [tuple(p) for p in pairs] == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]
    nested = [[[1, 2], [3]], [[4]]]
    assert one(spark, nested, arrays.flatten3(F.col("v"))) == [1, 2, 3, 4]
