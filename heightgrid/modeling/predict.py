"""Scoring of pixels with a fitted model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heightgrid.operators.filters import valid_pixels
from heightgrid.operators.scoring import clamp_predictions
from heightgrid.session import checkpoint
from heightgrid.settings import N_BANDS


def predict_pixels(model: PipelineModel, pixels: DataFrame, key: str = "tile_id", vector: str = "embedding", bands: int = N_BANDS) -> DataFrame:
    """``(key, cx, cy, height)`` for every pixel: no lower than 0, NaN where a band is not a number.

    Masked pixels ride along with a vector of zeros, so one pass scores everything and no join puts them back.
    Tiles without a single valid pixel give no rows; that is decided on the scored, narrow rows, so the vectors are
    read once and never shuffled.
    """
    marked = valid_pixels(pixels.select(key, "cx", "cy", vector), vector, bands)
    safe = F.when(F.col("valid"), F.transform(vector, lambda v: v.cast("double"))).otherwise(F.array_repeat(F.lit(0.0), bands))
    scored = clamp_predictions(model.transform(marked.withColumn("features", array_to_vector(safe))), "prediction", "valid", "height")
    narrow = checkpoint(scored.select(key, "cx", "cy", F.col("height").cast("float").alias("height"), "valid"))
    alive = narrow.where("valid").select(key).distinct()
    return narrow.join(alive, key, "left_semi").select(key, "cx", "cy", "height")
