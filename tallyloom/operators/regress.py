"""Least squares."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import comb

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.metrics import mse


@dataclass(frozen=True)
class LinearFit:
    """``y = intercept + Σ coefficient × column``."""

    columns: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        """The prediction as a Column, so that it runs inside the plan of its table."""
        value = F.lit(self.intercept)
        for name, k in zip(self.columns, self.coefficients):
            value = value + F.col(name) * F.lit(k)
        return value

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.column())

    def coefs(self, df: DataFrame) -> DataFrame:
        """``term, coefficient``, the intercept first."""
        rows = [("intercept", self.intercept), *zip(self.columns, self.coefficients)]
        return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


def fit_linear(df: DataFrame, xs: Sequence[str], y: str) -> LinearFit:
    """Ordinary least squares through the normal equations: one pass over the data."""
    rows = VectorAssembler(inputCols=list(xs), outputCol="_x").transform(df.select(*xs, y).dropna())
    solver = LinearRegression(featuresCol="_x", labelCol=y, solver="normal", regParam=0.0)
    model = solver.fit(rows.select("_x", F.col(y).cast("double").alias(y)))
    return LinearFit(tuple(xs), tuple(float(v) for v in model.coefficients), float(model.intercept))


@dataclass(frozen=True)
class PolyFit:
    """``y = Σ k[i] × ((x - centre) / scale)^i``."""

    x: str
    centre: float
    scale: float
    weights: tuple[float, ...]

    def column(self) -> Column:
        z = (F.col(self.x) - F.lit(self.centre)) / F.lit(self.scale)
        value = F.lit(self.weights[-1])
        for w in reversed(self.weights[:-1]):
            value = value * z + F.lit(w)
        return value

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.column())

    def raw_coefficients(self) -> list[float]:
        """Coefficients of 1, x, x², … in the original unit."""
        out = [0.0] * len(self.weights)
        for i, w in enumerate(self.weights):
            for j in range(i + 1):
                out[j] += w / self.scale**i * comb(i, j) * (-self.centre) ** (i - j)
        return out


def fit_poly(df: DataFrame, x: str, y: str, degree: int) -> PolyFit:
    """Polynomial least squares on centred and scaled x, which keeps raw years well conditioned."""
    stats = df.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).first()
    centre, scale = float(stats["m"]), float(stats["s"] or 1.0)
    z = (F.col(x) - F.lit(centre)) / F.lit(scale)
    powers = [F.lit(1.0)]
    for _ in range(degree):
        powers.append(powers[-1] * z)
    names = [f"_p{i}" for i in range(1, degree + 1)]
    rows = df.select(*[p.alias(n) for p, n in zip(powers[1:], names)], y)
    fit = fit_linear(rows, names, y)
    return PolyFit(x, centre, scale, (fit.intercept, *fit.coefficients))


def fill_series(df: DataFrame, x: str, y: str, lo: int, hi: int, degree: int = 1) -> DataFrame:
    """Every whole x from ``lo`` to ``hi`` with its value where known and the fitted value everywhere."""
    fit = fit_poly(df, x, y, degree)
    line = df.sparkSession.range(lo, hi + 1).select(F.col("id").alias(x))
    known = df.select(F.col(x).cast("long").alias(x), F.col(y))
    return fit.predict(line.join(known, x, "left"), "fitted").withColumn("filled", F.coalesce(F.col(y), "fitted"))


def learning_curve(train: DataFrame, test: DataFrame, x: str, y: str, degrees: Sequence[int]) -> DataFrame:
    """``degree, train_mse, test_mse``: one fit per degree."""
    rows = []
    for d in degrees:
        fit = fit_poly(train, x, y, d)
        errors = [mse(fit.predict(part), y, "prediction").first()["mse"] for part in (train, test)]
        rows.append((d, *errors))
    return train.sparkSession.createDataFrame(rows, "degree int, train_mse double, test_mse double")
