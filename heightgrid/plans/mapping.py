"""Job three: score a whole area, mosaic, clip, and build overviews."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heightgrid.functions.geometry import bbox
from heightgrid.modeling.predict import predict_pixels
from heightgrid.operators.filters import clip_to_square
from heightgrid.operators.grid import prediction_grid, pyramid
from heightgrid.operators.mosaic import mosaic_tiles
from heightgrid.operators.spatial_join import BOX, clip_cells
from heightgrid.settings import NODATA, Settings
from heightgrid.sources.outputs import pending, written_keys
from heightgrid.sources.rasters import read_cells, write_cells

#: Cells along a side of a written square of the map: a million cells to a task, however wide the area is.
BLOCK_CELLS = 1000


def area_of(sites: DataFrame, s: Settings, half: float = 10_000.0) -> DataFrame:
    """The area polygons with box columns, cut to a square round their centroid in test mode."""
    area = clip_to_square(sites, half) if s.test else sites
    return area.select("geom").withColumns({c: bbox("geom")[c] for c in BOX})


def assign_grid(pixels: DataFrame, grid: DataFrame, tile: float, res: float) -> DataFrame:
    """Grid id of every pixel by its centre; pixels outside the grid drop."""
    origin = grid.agg(
        F.min(F.col("xmin") - F.col("bcol") * F.lit(tile)).alias("_x0"), F.min(F.col("ymin") - F.col("brow") * F.lit(tile)).alias("_y0")
    )
    keyed = pixels.crossJoin(F.broadcast(origin)).withColumns(  # one row
        {
            "bcol": F.floor(((F.col("cx") + 0.5) * res - F.col("_x0")) / tile),
            "brow": F.floor(((F.col("cy") + 0.5) * res - F.col("_y0")) / tile),
        }
    )
    return keyed.drop("_x0", "_y0").join(grid.select("id", "bcol", "brow"), ["bcol", "brow"]).drop("bcol", "brow")


def map_heights(area: DataFrame, pixels: DataFrame, model: PipelineModel, out: str, s: Settings, levels: int = 3) -> dict[str, DataFrame]:
    """Predict the grid cells that are not written yet, then mosaic, clip and build overviews of all of them."""
    spark = area.sparkSession
    grid = prediction_grid(area, s.predict_tile, "geom")
    todo = pending(grid, written_keys(spark, f"{out}/tiles", "id"), ["id"])
    keyed = assign_grid(pixels.select("cx", "cy", "embedding"), todo, s.predict_tile, s.res_m)
    write_cells(predict_pixels(model, keyed, "id"), f"{out}/tiles", "id")
    merged = mosaic_tiles(read_cells(spark, f"{out}/tiles"), "height", order="id")
    clipped = clip_cells(merged, area, "geom", s.res_m, "height", NODATA)
    square = F.format_string("x%dy%d", F.floor(F.col("cx") / BLOCK_CELLS), F.floor(F.col("cy") / BLOCK_CELLS))
    write_cells(clipped.withColumn("square", square), f"{out}/clipped", "square", "overwrite")
    final = read_cells(spark, f"{out}/clipped")
    views = pyramid(final.where(F.col("height") != NODATA), "height", levels)
    return {"grid": grid, "map": final.drop("square"), "overviews": views}
