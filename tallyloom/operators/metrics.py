"""Quality measures. All class measures come from one small table of (truth, prediction) counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def mse(df: DataFrame, y: str, yhat: str) -> DataFrame:
    gap = F.col(y) - F.col(yhat)
    return df.agg(F.avg(gap * gap).alias("mse"))


def accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"))


def outcome_counts(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """``truth, predicted, n``: as many rows as pairs of classes occur."""
    return df.groupBy(F.col(y).alias("truth"), F.col(yhat).alias("predicted")).agg(F.count("*").alias("n"))


def classification_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """``label, precision, recall, f1, support`` per class, then accuracy, macro and weighted means; 0/0 is 0."""
    pairs = outcome_counts(df, y, yhat)
    right = F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("truth").alias("label"), F.lit(True).alias("is_truth"), "truth", "predicted", "n"),
        F.struct(F.col("predicted").alias("label"), F.lit(False).alias("is_truth"), "truth", "predicted", "n"),
    )).alias("s")).select("s.*")
    per = sides.groupBy("label").agg(
        F.sum(F.when(F.col("is_truth"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("is_truth"), F.col("n")).otherwise(0)).alias("called"),
        F.sum(F.when(F.col("is_truth") & (F.col("truth") == F.col("predicted")), F.col("n")).otherwise(0)).alias("hits"),
    )

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)

    scored = per.select(
        F.col("label").cast("string").alias("label"),
        ratio(F.col("hits"), F.col("called")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("called") + F.col("support")).alias("f1"),
        "support",
    )
    scores = ["precision", "recall", "f1"]
    macro = scored.agg(*[F.avg(s).alias(s) for s in scores], F.sum("support").alias("support"))
    weighted = scored.agg(
        *[(F.sum(F.col(s) * F.col("support")) / F.sum("support")).alias(s) for s in scores], F.sum("support").alias("support")
    )
    none = F.lit(None).cast("double")
    share = pairs.agg((right / F.sum("n")).alias("f1"), F.sum("n").alias("support"))
    share = share.select(F.lit("accuracy").alias("label"), none.alias("precision"), none.alias("recall"), "f1", "support")
    means = [m.select(F.lit(name).alias("label"), *scores, "support") for name, m in (("macro avg", macro), ("weighted avg", weighted))]
    return scored.union(share).union(means[0]).union(means[1])


def confusion_matrix(df: DataFrame, y: str, yhat: str, normalize: str | None = None) -> DataFrame:
    """``truth, predicted, n`` for every pair of classes; ``normalize`` = ``true``, ``pred`` or ``all`` adds ``share``."""
    pairs = outcome_counts(df, y, yhat)
    classes = pairs.select(F.explode(F.array("truth", "predicted")).alias("c")).agg(F.collect_set(F.struct("c")).alias("classes"))
    frame = classes.select(F.explode("classes.c").alias("truth"), "classes").select("truth", F.explode("classes.c").alias("predicted"))
    # Null is a class like any other.
    found = pairs.select(F.col("truth").alias("_truth"), F.col("predicted").alias("_predicted"), "n")
    same = F.col("truth").eqNullSafe(F.col("_truth")) & F.col("predicted").eqNullSafe(F.col("_predicted"))
    full = frame.join(found, same, "left").drop("_truth", "_predicted").fillna(0, ["n"])
    if normalize is None:
        return full
    over = {"true": W.partitionBy("truth"), "pred": W.partitionBy("predicted"), "all": W.partitionBy()}[normalize]
    total = F.sum("n").over(over)
    return full.withColumn("share", F.when(total > 0, F.col("n") / total).otherwise(0.0))


def most_confused(df: DataFrame, y: str, yhat: str, n: int) -> DataFrame:
    """The n most frequent wrong pairs."""
    wrong = outcome_counts(df, y, yhat).where(F.col("truth") != F.col("predicted"))
    return wrong.orderBy(F.desc("n"), "truth", "predicted").limit(n)
