"""Queries on features, splits, measures and regression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import features, metrics, regress
from tallyloom.plans.registry import Tables, query

c = F.col


def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({x: F.round(x, digits) for x in cols})


@query(
    "label_encode",
    """SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand_code, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type_code,
         p_type AS decoded FROM part""",
)
def label_encode(t: Tables) -> DataFrame:
    coded, codes = features.label_encode(t.part.select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"])
    return features.decode(coded.drop("p_brand", "p_type"), "p_type_code", codes["p_type"], "decoded")


@query(
    "standardise",
    """WITH tr AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd
         FROM lineitem WHERE l_returnflag <> 'R')
       SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_discount - md) / sd, 6) AS l_discount
       FROM lineitem, tr WHERE l_returnflag = 'R'""",
)
def standardise(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity", "l_discount")
    train, test = rows.where("l_returnflag <> 'R'"), rows.where("l_returnflag = 'R'")
    scaled = features.standardise(train, test, cols=["l_quantity", "l_discount"])[1]
    return _round(scaled.drop("l_returnflag"), 6, "l_quantity", "l_discount")


@query(
    "minmax_scale",
    """WITH e AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part)
       SELECT p_partkey, round(50 + (p_retailprice - lo) * (1950 / (hi - lo)), 6) AS size FROM part, e""",
)
def minmax_scale(t: Tables) -> DataFrame:
    scaled = features.minmax_scale(t.part.select("p_partkey", "p_retailprice"), "p_retailprice", 50, 2000, "size")
    return _round(scaled.drop("p_retailprice"), 6, "size")


@query(
    "poly_features",
    """SELECT l_orderkey, l_linenumber, l_partkey, 1.0::DOUBLE AS "1", l_quantity AS a, l_tax AS b, round(l_quantity * l_quantity, 6) AS "a^2",
         round(l_quantity * l_tax, 6) AS "a b", round(l_tax * l_tax, 6) AS "b^2" FROM lineitem""",
)
def poly_features(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", c("l_quantity").alias("a"), c("l_tax").alias("b"))
    made, names = features.poly_features(rows, ["a", "b"], 2)
    return _round(made, 6, *[n for n in names if n not in ("1", "a", "b")])


@query(
    "split_at",
    """SELECT o_orderkey, CASE WHEN rn <= 10000 THEN 'train' ELSE 'test' END AS part FROM
         (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)""",
)
def split_at(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    train, test = features.split_at(rows, ["o_orderdate", "o_orderkey"], 10000)
    both = train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))
    return both.select("o_orderkey", "part")


def _marked(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query("split_random")
def split_random(t: Tables) -> DataFrame:
    return _marked(*features.split_random(t.orders.select("o_orderkey"), "o_orderkey", 0.2, seed=42))


@query(
    "split_sizes",
    """SELECT part, n FROM (SELECT 'test' AS part, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n, count(*) AS k FROM orders) UNION ALL
       SELECT 'train', count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) FROM orders""",
)
def split_sizes(t: Tables) -> DataFrame:
    return split_random(t).distinct().groupBy("part").agg(F.count("*").alias("n"))


@query("split_stratified")
def split_stratified(t: Tables) -> DataFrame:
    return _marked(*features.split_stratified(t.embeddings.select("vec_id", "label"), "vec_id", "label", 0.7, seed=42))


@query(
    "split_stratified_sizes",
    "SELECT label, 'train' AS part, CAST(round_even(count(*) * 0.7, 0) AS BIGINT) AS n FROM embeddings GROUP BY 1 UNION ALL "
    "SELECT label, 'test', count(*) - CAST(round_even(count(*) * 0.7, 0) AS BIGINT) FROM embeddings GROUP BY 1",
)
def split_stratified_sizes(t: Tables) -> DataFrame:
    return split_stratified(t).groupBy("label", "part").agg(F.count("*").alias("n"))


@query(
    "kfold_assign",
    """SELECT vec_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) % 5 AS INTEGER) AS fold FROM embeddings""",
)
def kfold_assign(t: Tables) -> DataFrame:
    return features.kfold_assign(t.embeddings.select("vec_id", "label"), "vec_id", "label", 5)


def _guesses(t: Tables) -> DataFrame:
    """A label and a guess that is often right."""
    return t.lineitem.select(
        (c("l_linenumber") % 4).alias("y"),
        F.when(c("l_quantity") < 35, c("l_linenumber") % 4).otherwise((c("l_partkey") % 4).cast("int")).alias("yhat"),
        "l_quantity",
        (c("l_extendedprice") / 1800).alias("guess"),
    )


_GUESSES = """g AS (SELECT CAST(l_linenumber % 4 AS INTEGER) AS y, CAST(CASE WHEN l_quantity < 35 THEN l_linenumber % 4 ELSE l_partkey % 4 END
  AS INTEGER) AS yhat, l_quantity, l_extendedprice / 1800 AS guess FROM lineitem)"""


@query("mse", f"WITH {_GUESSES} SELECT round(avg((l_quantity - guess) * (l_quantity - guess)), 6) AS mse FROM g")
def mse(t: Tables) -> DataFrame:
    return _round(metrics.mse(_guesses(t), "l_quantity", "guess"), 6, "mse")


@query("accuracy", f"WITH {_GUESSES} SELECT round(avg(CASE WHEN y = yhat THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM g")
def accuracy(t: Tables) -> DataFrame:
    return _round(metrics.accuracy(_guesses(t), "y", "yhat"), 6, "accuracy")


@query(
    "classification_report",
    f"""WITH {_GUESSES}, l AS (SELECT y AS label FROM g UNION SELECT yhat FROM g),
        k AS (SELECT label, (SELECT count(*) FROM g WHERE y = label) AS support, (SELECT count(*) FROM g WHERE yhat = label) AS called,
          (SELECT count(*) FROM g WHERE yhat = label AND y = label) AS hits FROM l),
        s AS (SELECT CAST(label AS VARCHAR) AS label, CASE WHEN called > 0 THEN hits / called ELSE 0 END AS p,
          CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r, 2 * hits / (called + support) AS f, support FROM k)
        SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM s
        UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT round(avg(CASE WHEN y = yhat THEN 1.0::DOUBLE ELSE 0 END), 6) FROM g), (SELECT count(*) FROM g)
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM s
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
          round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM s""",
)
def classification_report(t: Tables) -> DataFrame:
    return _round(metrics.classification_report(_guesses(t), "y", "yhat"), 6, "precision", "recall", "f1")


@query(
    "confusion_matrix",
    f"""WITH {_GUESSES}, l AS (SELECT y AS label FROM g UNION SELECT yhat FROM g),
        k AS (SELECT a.label AS truth, b.label AS predicted, (SELECT count(*) FROM g WHERE y = a.label AND yhat = b.label) AS n FROM l a, l b)
        SELECT truth, predicted, n, round(n / sum(n) OVER (PARTITION BY truth), 6) AS share FROM k""",
)
def confusion_matrix(t: Tables) -> DataFrame:
    return _round(metrics.confusion_matrix(_guesses(t), "y", "yhat", "true"), 6, "share")


@query(
    "most_confused",
    f"""WITH {_GUESSES} SELECT y AS truth, yhat AS predicted, count(*) AS n FROM g WHERE y <> yhat GROUP BY 1, 2
        ORDER BY n DESC, truth, predicted LIMIT 5""",
)
def most_confused(t: Tables) -> DataFrame:
    return metrics.most_confused(_guesses(t), "y", "yhat", 5)


@query(
    "linreg_simple",
    """SELECT 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity), 4) AS coefficient FROM lineitem
       UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem""",
)
def linreg_simple(t: Tables) -> DataFrame:
    fit = regress.fit_linear(t.lineitem, ["l_quantity"], "l_extendedprice")
    return _round(fit.coefs(t.lineitem), 4, "coefficient")


@query(
    "linreg_poly",
    """WITH d AS (SELECT p_retailprice AS y, p_size - (SELECT avg(p_size) FROM part) AS z FROM part),
         m AS (SELECT count(*)::DOUBLE AS n, sum(z) AS s1, sum(z*z) AS s2, sum(z*z*z) AS s3, sum(z*z*z*z) AS s4, sum(y) AS t0, sum(z*y) AS t1,
           sum(z*z*y) AS t2, (SELECT avg(p_size) FROM part) AS c FROM d),
         r AS (SELECT *, n*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2) AS det FROM m),
         k AS (SELECT c, (t0*(s2*s4-s3*s3) - s1*(t1*s4-t2*s3) + s2*(t1*s3-t2*s2)) / det AS w0,
           (n*(t1*s4-t2*s3) - t0*(s1*s4-s2*s3) + s2*(s1*t2-s2*t1)) / det AS w1,
           (n*(s2*t2-s3*t1) - s1*(s1*t2-s2*t1) + t0*(s1*s3-s2*s2)) / det AS w2 FROM r)
       SELECT 0 AS power, round(w0 - w1*c + w2*c*c, 4) AS coefficient FROM k UNION ALL SELECT 1, round(w1 - 2*w2*c, 4) FROM k
       UNION ALL SELECT 2, round(w2, 4) FROM k""",
)
def linreg_poly(t: Tables) -> DataFrame:
    fit = regress.fit_poly(t.part, "p_size", "p_retailprice", 2)
    rows = [(i, round(k, 4)) for i, k in enumerate(fit.raw_coefficients())]
    return t.spark.createDataFrame(rows, "power int, coefficient double")


@query(
    "linreg_multi",
    """WITH m AS (SELECT var_pop(l_quantity) AS aa, var_pop(l_discount) AS bb, covar_pop(l_quantity, l_discount) AS ab,
         covar_pop(l_quantity, l_extendedprice) AS ay, covar_pop(l_discount, l_extendedprice) AS by_, avg(l_quantity) AS a, avg(l_discount) AS b,
         avg(l_extendedprice) AS y FROM lineitem),
         k AS (SELECT *, (ay*bb - by_*ab) / (aa*bb - ab*ab) AS ka, (by_*aa - ay*ab) / (aa*bb - ab*ab) AS kb FROM m)
       SELECT 'intercept' AS term, round(y - ka*a - kb*b, 3) AS coefficient FROM k UNION ALL SELECT 'l_quantity', round(ka, 3) FROM k
       UNION ALL SELECT 'l_discount', round(kb, 3) FROM k""",
)
def linreg_multi(t: Tables) -> DataFrame:
    fit = regress.fit_linear(t.lineitem, ["l_quantity", "l_discount"], "l_extendedprice")
    return _round(fit.coefs(t.lineitem), 3, "coefficient")


@query(
    "fill_series",
    """WITH y AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*)::DOUBLE AS n FROM orders GROUP BY 1 HAVING year <> 1997),
         e AS (SELECT min(year) AS lo, max(year) AS hi, regr_slope(n, year) AS k, regr_intercept(n, year) AS i FROM y),
         f AS (SELECT unnest(range(lo, hi + 6)) AS year, k, i FROM e)
       SELECT f.year, y.n, round(k * f.year + i, 4) AS fitted, round(coalesce(y.n, k * f.year + i), 4) AS filled
       FROM f LEFT JOIN y ON y.year = f.year""",
)
def fill_series(t: Tables) -> DataFrame:
    yearly = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").cast("double").alias("n")).where("year <> 1997")
    ends = yearly.agg(F.min("year").alias("lo"), F.max("year").alias("hi")).first()
    filled = regress.fill_series(yearly, "year", "n", ends["lo"], ends["hi"] + 5)
    return _round(filled, 4, "fitted", "filled")


@query("learning_curve")
def learning_curve(t: Tables) -> DataFrame:
    train, test = features.split_random(t.part.select("p_partkey", "p_size", "p_retailprice"), "p_partkey", 0.3, seed=1)
    return regress.learning_curve(train, test, "p_size", "p_retailprice", [1, 2, 3, 4])
