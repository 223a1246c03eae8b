"""Key joins of samples with attributes and pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from heightgrid.operators.spatial_join import sample_cells


def attach_by_id(left: DataFrame, right: DataFrame, key: str = "id", suffix: str = "_embeddings") -> DataFrame:
    """Left join on a key; columns of the right side whose name is taken get the suffix."""
    clash = {c: f"{c}{suffix}" for c in right.columns if c in left.columns and c != key}
    return left.join(right.withColumnsRenamed(clash), key, "left")


def sample_points(points: DataFrame, pixels: DataFrame, res: float) -> DataFrame:
    """Pixel values at points; points without data drop out."""
    return sample_cells(points, pixels, res, how="inner").drop("cx", "cy")
