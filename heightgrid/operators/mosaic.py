"""Image stacks: selection, mosaic, masks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def images_between(images: DataFrame, start, end, bounds: tuple | None = None, date: str = "image_date") -> DataFrame:
    """Images of a half-open date span whose cells fall in closed cell bounds; both filters reach the scan."""
    out = images.where((F.col(date) >= F.lit(start)) & (F.col(date) < F.lit(end)))
    if bounds is not None:
        x1, y1, x2, y2 = bounds
        out = out.where(F.col("cx").between(x1, x2) & F.col("cy").between(y1, y2))
    return out


def mosaic(images: DataFrame, values: list[str], keys=("cx", "cy"), order=("image_date", "image_id")) -> DataFrame:
    """Latest valid image on top, per pixel; partial maxima combine before the shuffle."""
    valid = reduce(lambda a, b: a & b, [F.col(v).isNotNull() for v in values])
    top = F.max_by(F.struct(*values), F.struct(*order))
    return images.where(valid).groupBy(*keys).agg(top.alias("_top")).select(*keys, "_top.*")


def forest_mask(image: DataFrame, bands=("b1", "b2", "b3"), empty: int = 127, out: str = "forest") -> DataFrame:
    """1 where any band carries a forest class, 0 elsewhere."""
    return image.withColumn(out, reduce(lambda a, b: a | b, [F.col(b) != empty for b in bands]).cast("int"))


def mosaic_tiles(tiles: DataFrame, value: str, keys=("cx", "cy"), order: str = "tile_id") -> DataFrame:
    """Mosaic of prediction tiles: where tiles overlap the last one wins."""
    return mosaic(tiles.where(~F.isnan(value)), [value], keys, (order,))
