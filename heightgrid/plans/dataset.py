"""Job one: from points, tiles and pixels to the training table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heightgrid.functions.geometry import box_geom, is_valid
from heightgrid.functions.rand import stable_id
from heightgrid.functions.text import project_year
from heightgrid.operators import sampling, stats, zones
from heightgrid.operators.filters import latest_or_given_year
from heightgrid.operators.grid import cut, stratify, stratum_label
from heightgrid.operators.ground import classify_ground, height_above_ground
from heightgrid.operators.joins import attach_by_id, sample_points
from heightgrid.operators.points import height_grid, in_range
from heightgrid.operators.spatial_join import (
    BOX,
    cells_minus_boxes,
    cells_minus_polygons,
    overlay_boxes_grid,
    points_to_grid_blocks,
    spatial_semi_join,
    zonal_mean,
)
from heightgrid.session import checkpoint, with_row
from heightgrid.settings import COVER_EDGES, COVER_LABELS, Settings
from heightgrid.sources.outputs import pending


def clean_tiles(
    tiles: DataFrame, forest: DataFrame, forest_res: float, water: DataFrame, min_cover: float, res: float, n_std: float = 3.0
) -> tuple[DataFrame, DataFrame]:
    """Tiles with enough forest, their area without water, and no tile much smaller than the rest.

    Water counts by its polygons where it carries ``geom``, else by its boxes.
    Returns the tiles (with ``cover`` and ``area``) and their dry cells. Both are read several times further on, so
    they are written once (checkpoint) instead of being worked out again at every use.
    """
    cover = zonal_mean(tiles, forest, "forest", forest_res, ["tile_id"], "cover").where(F.col("cover") >= min_cover)
    wooded = checkpoint(tiles.join(cover, "tile_id"))
    polygons = "geom" in water.columns
    dry = checkpoint(cells_minus_polygons(wooded, water, "tile_id", "geom", res) if polygons else cells_minus_boxes(wooded, water, "tile_id", res))
    area = dry.groupBy("tile_id").agg((F.count(F.lit(1)) * F.lit(float(res * res))).alias("area"))
    kept = stats.drop_small(area, "area", n_std)
    return wooded.join(kept, "tile_id"), dry.join(kept.select("tile_id"), "tile_id", "left_semi")


@dataclass
class TilePlan:
    tiles: DataFrame  # sampled tiles, one row per (tile, block)
    blocks: DataFrame
    dry_cells: DataFrame
    points_per_tile: DataFrame  # one row


def select_tiles(tiles: DataFrame, area: DataFrame, forest: DataFrame, water: DataFrame, s: Settings, year: int | None = None, done: DataFrame | None = None) -> TilePlan:
    """Tiles of the area, clean, dealt over blocks and cover strata, and sampled; of one year only if one is given.

    The area comes first: the year is looked for among its own tiles, whatever other places hold.

    ``area`` carries ``geom`` and its box columns; ``tiles`` carries ``tile_id``, ``project`` and box columns.
    """
    shaped = tiles.withColumn("year", project_year("project")).withColumn("t_geom", box_geom())
    inside = spatial_semi_join(shaped, area.select("geom", *BOX), ["tile_id"], "t_geom", "geom").where(is_valid("t_geom"))
    inside = checkpoint((inside if year is None else latest_or_given_year(inside, year)).drop("t_geom"))
    kept, dry = clean_tiles(inside, forest, s.forest_pixel, water, s.min_forest_cover, s.res_m, s.small_tile_std)
    kept = checkpoint(kept)  # used for blocks, overlay and sampling
    blocks = checkpoint(sampling.spatial_blocks(kept, s.block_width, s.block_height, s.n_folds, s.seed, s.block_method))
    pairs = overlay_boxes_grid(kept, blocks, s.block_width, s.block_height).withColumn("cover_strata", cut("cover", COVER_EDGES, COVER_LABELS))
    ids = ["tile_id", "bcol", "brow"]
    chosen = sampling.stratified_sample(
        pairs.where(F.col("cover_strata").isNotNull()), ["cover_strata", "folds"], s.seed, ids, s.min_n_per_tile
    )
    chosen = checkpoint(chosen)
    per_tile = sampling.points_per_tile(chosen, s.n_samples)
    if s.test:
        chosen = sampling.sample_per_group(chosen, ["folds"], 1, s.seed, ids)
    return TilePlan(pending(chosen, done, ["tile_id"]), blocks, dry, per_tile)


def sample_heights(points: DataFrame, plan: TilePlan, s: Settings, ground_known: bool = False) -> DataFrame:
    """Height grid of the chosen tiles, strata, large zones, and height-weighted random points with their heights.

    Each chosen (tile, block) has draws of its own, from its own cells: parts of a tile in other blocks give none.
    """
    wanted = plan.tiles.select("tile_id").distinct()
    pts = points.join(wanted, "tile_id", "left_semi")
    pts = height_above_ground(pts if ground_known else classify_ground(pts))
    chm = checkpoint(height_grid(in_range(pts, "hag", 0.0, s.max_height), s.statistic, s.res_m).drop("n"))
    strata = stratify(chm, "height", s.height_edges)
    if s.exclude_water:
        strata = strata.join(plan.dry_cells, ["tile_id", "cx", "cy"], "left_semi")
    zoned = zones.label_zones(strata.select("tile_id", "cx", "cy", "strata"))
    large = checkpoint(zones.large_zones(zoned, s.min_area, s.res_m).select("tile_id", "strata", "cx", "cy"))
    k = len(s.height_edges)
    part = ["tile_id", "bcol", "brow"]
    centres = large.withColumns({"_px": (F.col("cx") + 0.5) * s.res_m, "_py": (F.col("cy") + 0.5) * s.res_m})
    placed = points_to_grid_blocks(centres, plan.blocks, s.block_width, s.block_height, "_px", "_py")
    placed = checkpoint(placed.join(plan.tiles.select(*part), part, "left_semi").select(*part, "strata", "cx", "cy"))
    counts = with_row(placed.select(*part, "strata").distinct(), plan.points_per_tile.select("points_per_tile"))
    counts = counts.withColumn("n", sampling.allocation("strata", "points_per_tile", k, s.label_offset))
    drawn = sampling.random_points(placed, [*part, "strata"], counts.drop("points_per_tile"), "n", s.res_m, s.seed)
    drawn = drawn.withColumn("label", stratum_label("strata", s.height_labels, s.label_offset))
    # a draw takes the height of its own tile, also where tiles overlap
    high = drawn.join(chm, ["tile_id", "cx", "cy"]).drop("cx", "cy")
    high = high.where((F.col("height") > s.min_height) & (F.col("height") < s.max_height))
    return high.withColumn("id", stable_id(*part, "strata", "draw")).drop("draw", "bcol", "brow")


def build_training_table(samples: DataFrame, blocks: DataFrame, pixels: DataFrame, s: Settings) -> DataFrame:
    """Folds from the blocks, embeddings by position, outliers in height removed."""
    folded = points_to_grid_blocks(samples, blocks, s.block_width, s.block_height).drop("bcol", "brow")
    bands = sample_points(folded.select("id", "x", "y"), pixels.select("cx", "cy", "embedding"), s.res_m)
    joined = attach_by_id(folded, bands.select("id", "embedding"), "id")
    return stats.remove_outliers(joined, "height", s.z_threshold)


def build_dataset(
    points, tiles, area, forest, water, pixels, s: Settings, year: int | None = None, done: DataFrame | None = None
) -> DataFrame:
    """The whole job as one chain of Spark plans; tiles whose ``tile_id`` is in ``done`` are left out."""
    plan = select_tiles(tiles, area, forest, water, s, year, done)
    samples = checkpoint(sample_heights(points, plan, s))
    return build_training_table(samples, plan.blocks, pixels, s)

