"""Point-cloud stages and height grids."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heightgrid.functions.geometry import contains_xy
from heightgrid.operators.grid import cell_key

GROUND_CLASS = 2  # fixed value: ASPRS class code of ground


def in_bounds(points: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Points of a box, ends included; reaches the Parquet scan as a pushed filter."""
    return points.where(F.col("x").between(xmin, xmax) & F.col("y").between(ymin, ymax))


def in_polygon(points: DataFrame, polygon, bounds: tuple) -> DataFrame:
    """Points of one polygon: the box first (pushed to the scan), then ray casting."""
    return in_bounds(points, *bounds).where(contains_xy(polygon, "x", "y"))


def in_range(points: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Range stage, both ends included."""
    return points.where(F.col(column).between(low, high))


def matching(points: DataFrame, expression: str) -> DataFrame:
    """Free-text expression stage."""
    return points.where(F.expr(expression))


def ground_only(points: DataFrame) -> DataFrame:
    return points.where(F.col("classification") == GROUND_CLASS)


def merge_clouds(clouds: Iterable[DataFrame]) -> DataFrame:
    """Union of clouds; a column some of them lack becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), clouds)


def run_stages(points: DataFrame, stages: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply stages in order; they fold into one plan."""
    return reduce(lambda df, stage: df.transform(stage), stages, points)


def height_grid(
    points: DataFrame,
    statistic: str = "P95",
    res: float = 10.0,
    value: str = "hag",
    keys: tuple = ("tile_id",),
    max_height: float | None = None,
    out: str = "height",
) -> DataFrame:
    """One value per grid cell from the points inside it, plus the point count ``n``.

    Percentiles are exact. Points are first counted per (cell, value), which combines map-side and spreads a crowded
    cell over all reducers; what is left for a cell is its distinct heights, at most (range / storage step) of them.
    """
    pts = points if max_height is None else in_range(points, value, 0.0, max_height)
    cx, cy = cell_key("x", "y", res)
    pts = pts.select(*keys, cx.alias("cx"), cy.alias("cy"), F.col(value).alias("_v"))
    cells = [*keys, "cx", "cy"]
    name = statistic.lower()
    percent = re.fullmatch(r"p(\d{1,3}(?:\.\d+)?)", name)
    if percent and float(percent.group(1)) <= 100:
        p = float(percent.group(1)) / 100
        counted = pts.groupBy(*cells, "_v").agg(F.count(F.lit(1)).alias("_n"))
        return counted.groupBy(*cells).agg(
            F.round(F.expr(f"percentile(_v, {p}D, _n)"), 6).alias(out), F.sum("_n").alias("n")
        )
    simple = {
        "min": F.min, "max": F.max, "mean": F.avg, "count": F.count, "stdev": F.stddev_samp, "stddev": F.stddev_samp,
    }
    if name not in simple:
        raise ValueError(f"unknown statistic: {statistic}")
    return pts.groupBy(*cells).agg(
        F.round(simple[name]("_v").cast("double"), 6).alias(out), F.count(F.lit(1)).alias("n")
    )
