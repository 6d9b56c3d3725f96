"""Gaussian naive Bayes in closed form: moments per class from one aggregate, scores as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

SMOOTHING = 1e-9  # added to every variance, as a share of the largest one


class _Columns(Params):
    featuresCols = Param(Params._dummy(), "featuresCols", "number columns that are read", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "classes, numbered from 0", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight of a row; empty: each counts 1", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="label", weightCol="")

    def setWeightCol(self, value: str):
        return self._set(weightCol=value)


class GaussianBayes(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Classifier that takes every feature for normal and independent of the others within a class.

    Fitting is two aggregates over the rows: the means, then the sums of distances from them and their squares per class, so that
    large numbers lose no digits. A missing feature is left out of its moments, and of a score; a class that
    never has a feature takes the moments of all rows. Rows without a label or weight do not count.
    """

    @keyword_only
    def __init__(self, *, featuresCols: Sequence[str] | None = None, labelCol: str = "label", weightCol: str = ""):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> GaussianBayesModel:
        cols, label, by = self.getOrDefault("featuresCols"), self.getOrDefault("labelCol"), self.getOrDefault("weightCol")
        weight = F.col(by).cast("double") if by else F.lit(1.0)
        rows = dataset.select(F.col(label).cast("int").alias("_y"), weight.alias("_w"), *[F.col(c).cast("double").alias(c) for c in cols])
        rows = rows.filter(F.col("_y").isNotNull() & (F.col("_w") > 0))
        means = rows.agg(*[F.avg(c) for c in cols]).first() if cols else ()
        centres = [float(round(m)) if m is not None and math.isfinite(m) else 0.0 for m in means]
        apart = [(F.when(F.col(c).isNotNull(), F.col("_w")), F.col(c) - F.lit(m)) for c, m in zip(cols, centres)]
        sums = rows.groupBy("_y").agg(F.sum("_w").alias("_n"), *[
            F.sum(s).alias(f"_{kind}{i}") for i, (w, d) in enumerate(apart) for kind, s in (("k", w), ("s", w * d), ("q", w * d * d))]).collect()
        return _model(self, sums, cols, centres)


def _model(source: GaussianBayes, sums: list, cols: Sequence[str], centres: Sequence[float]) -> GaussianBayesModel:
    """Moments from sums: one row per class, whatever the number of rows."""
    classes = 1 + max((r["_y"] for r in sums), default=-1)
    total = sum(r["_n"] for r in sums)
    counts = {r["_y"]: r for r in sums}

    def moments(rows: list, i: int) -> tuple[float, float] | None:
        k, s, q = (sum(r[f"_{kind}{i}"] or 0.0 for r in rows) for kind in "ksq")
        return (centres[i] + s / k, max(q / k - (s / k) * (s / k), 0.0)) if k else None

    whole = [moments(sums, i) or (0.0, 1.0) for i in range(len(cols))]
    least = SMOOTHING * max((v for _, v in whole), default=0.0) or SMOOTHING
    own = [[(moments([counts[y]], i) if y in counts else None) or whole[i] for i in range(len(cols))] for y in range(classes)]
    model = GaussianBayesModel()
    return model._set(
        featuresCols=list(cols), labelCol=source.getOrDefault("labelCol"),
        shares=[counts[y]["_n"] / total if y in counts else 0.0 for y in range(classes)],
        means=[m for row in own for m, _ in row], variances=[v + least for row in own for _, v in row])


class GaussianBayesModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds `probability`, an array with the share of every class, and `prediction`, the class with the largest (of equal ones the first)."""

    shares = Param(Params._dummy(), "shares", "share of rows per class", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "means, class after class", TypeConverters.toListFloat)
    variances = Param(Params._dummy(), "variances", "variances, class after class", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols, shares = self.getOrDefault("featuresCols"), self.getOrDefault("shares")
        means, variances = self.getOrDefault("means"), self.getOrDefault("variances")

        def log_of(y: int) -> Column:
            total = F.lit(math.log(shares[y])) if shares[y] > 0 else F.lit(float("-inf"))
            for i, c in enumerate(cols):
                mean, variance = means[y * len(cols) + i], variances[y * len(cols) + i]
                away = F.col(c).cast("double") - F.lit(mean)
                total = total - F.coalesce(F.lit(0.5) * (F.lit(math.log(2 * math.pi * variance)) + away * away / F.lit(variance)), F.lit(0.0))
            return total

        out = dataset.withColumn("_logs", F.array(*[log_of(y) for y in range(len(shares))]))
        out = out.withColumn("_parts", F.transform("_logs", lambda x: F.exp(x - F.array_max("_logs"))))
        whole = F.aggregate("_parts", F.lit(0.0), lambda s, x: s + x)
        first = F.array_position("_logs", F.array_max("_logs")) - 1
        return out.withColumns({
            "probability": F.transform("_parts", lambda x: x / whole), "prediction": first.cast("double")}).drop("_logs", "_parts")
