"""Scores of embedding pixels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def linear_score(vector: str, coefficients: list[float], intercept: float) -> Column:
    """Dot product with fixed coefficients; no Python worker takes part."""
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    return F.aggregate(F.zip_with(vector, weights, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v) + intercept


def clamp_predictions(df: DataFrame, prediction: str, valid: str, out: str = "height") -> DataFrame:
    """Predictions no lower than 0; masked pixels are NaN."""
    return df.withColumn(out, F.when(F.col(valid), F.greatest(F.col(prediction), F.lit(0.0))).otherwise(F.lit(float("nan"))))
