"""Spatial joins as equi-joins on grid buckets whose size follows each feature's own extent.

A feature of extent ``e`` gets the level ``L`` with ``2**L >= e`` and so covers at most four buckets of that size.
A pair meets at the larger of its two levels. Small features are matched against large ones in large buckets and
against small ones in small buckets, so the number of candidates follows the number of overlapping boxes, also where
one place holds most features; nobody has to guess a bucket size. Each pair is kept in one bucket only (the one that
holds the lower left corner of the common box), so no ``distinct`` is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heightgrid.functions.geometry import edges_intersect, first_vertices, flat_edges
from heightgrid.operators.cover import BOX, FEW, cell_box, extent_level, in_cell, in_laid_out, laid_out, polygon_cells, size_of
from heightgrid.session import checkpoint, with_row, worker_partitions

#: Sides of a cell of polygons, in cells of the raster it meets, below which it is not cut.
WET_CELLS = 8


def _keyed(df: DataFrame, box, own: Column, other_levels: DataFrame, tag: str, open_edges: bool) -> DataFrame:
    """One row per (level, bucket) the feature has to be looked up in: its own level only where the other side has one no larger,
    and not the bucket that an open box ends at."""
    xmin, ymin, xmax, ymax = (F.col(c) for c in box)
    level = F.col(f"_{tag}lvl")
    levels = F.array_distinct(F.transform("_levels", lambda v: F.greatest(v, level)))
    first = lambda low: F.floor(low / F.col("_size"))
    last = lambda low, high: F.greatest(F.ceil(high / F.col("_size")) - 1, first(low)) if open_edges else first(high)
    df = with_row(df.withColumn(f"_{tag}lvl", own), other_levels)
    df = df.withColumn("_lvl", F.explode(levels)).drop("_levels").withColumn("_size", F.pow(F.lit(2.0), F.col("_lvl")))
    df = df.withColumn("_bx", F.explode(F.sequence(first(xmin), last(xmin, xmax))))
    return df.withColumn(
        "_by", F.explode(F.sequence(first(ymin), last(ymin, ymax)))
    )


def bucket_pairs(left: DataFrame, right: DataFrame, left_box=BOX, right_box=BOX, open_edges: bool = False) -> DataFrame:
    """All pairs whose boxes meet (closed), or overlap with positive area when ``open_edges``.

    Column names of the two sides must differ, apart from the boxes, which keep the suffixes ``_l`` and ``_r``.
    """
    lb, rb = [f"{c}_l" for c in BOX], [f"{c}_r" for c in BOX]
    lefts = left.withColumnsRenamed(dict(zip(left_box, lb, strict=True)))
    rights = right.withColumnsRenamed(dict(zip(right_box, rb, strict=True)))
    clash = set(lefts.columns) & set(rights.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    l_lvl, r_lvl = extent_level(*lb), extent_level(*rb)
    l_levels = lefts.agg(F.collect_set(l_lvl).alias("_levels"))
    r_levels = rights.agg(F.collect_set(r_lvl).alias("_levels"))
    a = _keyed(lefts, lb, l_lvl, r_levels, "l", open_edges)
    b = _keyed(rights, rb, r_lvl, l_levels, "r", open_edges).withColumnRenamed("_size", "_size_r")
    pairs = a.join(b, ["_lvl", "_bx", "_by"])
    c = F.col
    meet = (
        (c("xmin_l") <= c("xmax_r")) & (c("xmax_l") >= c("xmin_r"))
        & (c("ymin_l") <= c("ymax_r")) & (c("ymax_l") >= c("ymin_r"))
    )
    if open_edges:
        meet = (
            (c("xmin_l") < c("xmax_r")) & (c("xmax_l") > c("xmin_r"))
            & (c("ymin_l") < c("ymax_r")) & (c("ymax_l") > c("ymin_r"))
        )
    once = (
        (c("_lvl") == F.greatest("_llvl", "_rlvl"))
        & (c("_bx") == F.floor(F.greatest("xmin_l", "xmin_r") / c("_size")))
        & (c("_by") == F.floor(F.greatest("ymin_l", "ymin_r") / c("_size")))
    )
    return pairs.where(meet & once).drop("_lvl", "_bx", "_by", "_size", "_size_r", "_llvl", "_rlvl")


def spatial_join(left: DataFrame, right: DataFrame, left_geom: str, right_geom: str, left_box=BOX, right_box=BOX):
    """Inner join on ``intersects``; one row per matching pair. Edges are prepared once per feature."""
    a = left.withColumns({"_le": flat_edges(left_geom), "_lf": first_vertices(left_geom)})
    b = right.withColumns({"_re": flat_edges(right_geom), "_rf": first_vertices(right_geom)})
    pairs = bucket_pairs(a, b, left_box, right_box)
    return pairs.where(edges_intersect("_le", "_lf", "_re", "_rf")).drop("_le", "_lf", "_re", "_rf")


def spatial_semi_join(left: DataFrame, right: DataFrame, keys: list[str], left_geom: str, right_geom: str) -> DataFrame:
    """Rows of ``left`` that meet the union of ``right``: meeting the union is meeting one of its members."""
    slim = left.select(*keys, left_geom, *BOX)
    hits = spatial_join(slim, right.select(right_geom, *BOX), left_geom, right_geom).select(*keys).distinct()
    return left.join(hits, keys, "left_semi")


def points_in_boxes(points: DataFrame, boxes: DataFrame, x: str = "x", y: str = "y", box=BOX) -> DataFrame:
    """Inner join of points to half-open boxes ``[min, max)``.

    A point is looked up once per level that occurs among the boxes (one level for equal boxes).
    """
    rb = [f"{c}_r" for c in BOX]
    rights = boxes.withColumnsRenamed(dict(zip(box, rb, strict=True)))
    lvl = extent_level(*rb)
    levels = rights.agg(F.collect_set(lvl).alias("_levels"))
    size = F.pow(F.lit(2.0), F.col("_lvl"))
    a = with_row(points, levels).withColumn("_lvl", F.explode("_levels")).drop("_levels")
    a = a.withColumns({"_bx": F.floor(F.col(x) / size), "_by": F.floor(F.col(y) / size)})
    b = rights.withColumn("_lvl", lvl)
    b = b.withColumn("_bx", F.explode(F.sequence(F.floor(F.col("xmin_r") / size), F.floor(F.col("xmax_r") / size))))
    b = b.withColumn("_by", F.explode(F.sequence(F.floor(F.col("ymin_r") / size), F.floor(F.col("ymax_r") / size))))
    inside = (
        (F.col(x) >= F.col("xmin_r")) & (F.col(x) < F.col("xmax_r"))
        & (F.col(y) >= F.col("ymin_r")) & (F.col(y) < F.col("ymax_r"))
    )
    return a.join(b, ["_lvl", "_bx", "_by"]).where(inside).drop("_lvl", "_bx", "_by")


def points_in_polygons(points: DataFrame, polygons: DataFrame, geom: str, x: str = "x", y: str = "y") -> DataFrame:
    """Inner join of points to the polygons that hold them; points outside all polygons drop.

    Polygons meet points as cells of a cover, so the points of one large polygon have as many keys as it has cells, and
    a candidate carries the edges of one cell at most, none in the interior.
    """
    keep = [c for c in polygons.columns if c not in (geom, *BOX)]
    cells = checkpoint(polygon_cells(polygons, geom, keep))
    levels = cells.agg(F.collect_set("lvl").alias("_levels"))
    keyed = with_row(points, levels).withColumn("lvl", F.explode("_levels")).drop("_levels")
    keyed = keyed.withColumns({"ix": F.floor(F.col(x) / size_of()), "iy": F.floor(F.col(y) / size_of())})
    usual = keyed.join(laid_out(cells), ["lvl", "ix", "iy"]).where(in_laid_out(x, y))
    crowded = keyed.join(cells.where(F.size("edges") > 2), ["lvl", "ix", "iy"]).where(in_cell(x, y))
    columns = [*points.columns, *keep]
    return usual.select(*columns).unionAll(crowded.select(*columns))


def grid_index(x: Column, origin: Column, step: float) -> Column:
    return F.floor((x - origin) / F.lit(float(step)))


def _origin(blocks: DataFrame, width: float, height: float) -> DataFrame:
    return blocks.agg(
        F.min(F.col("xmin") - F.col("bcol") * F.lit(float(width))).alias("_x0"),
        F.min(F.col("ymin") - F.col("brow") * F.lit(float(height))).alias("_y0"),
    )


def overlay_boxes_grid(boxes: DataFrame, blocks: DataFrame, width: float, height: float) -> DataFrame:
    """Overlay of boxes with regular grid blocks: one row per pair with common area, box clipped to the block.

    The block index follows from the coordinates, so this is an equi-join on ``(bcol, brow)``.
    """
    w, h = F.lit(float(width)), F.lit(float(height))
    a = with_row(boxes, _origin(blocks, width, height))
    a = a.withColumn(
        "bcol",
        F.explode(F.sequence(grid_index(F.col("xmin"), F.col("_x0"), width), F.ceil((F.col("xmax") - F.col("_x0")) / w) - 1)),
    ).withColumn(
        "brow",
        F.explode(F.sequence(grid_index(F.col("ymin"), F.col("_y0"), height), F.ceil((F.col("ymax") - F.col("_y0")) / h) - 1)),
    )
    b = blocks.withColumnsRenamed({c: f"{c}_r" for c in BOX})
    return (
        a.join(b, ["bcol", "brow"])
        .withColumns(
            {
                "xmin": F.greatest("xmin", "xmin_r"), "ymin": F.greatest("ymin", "ymin_r"),
                "xmax": F.least("xmax", "xmax_r"), "ymax": F.least("ymax", "ymax_r"),
            }
        )
        .drop("_x0", "_y0", *[f"{c}_r" for c in BOX])
    )


def points_to_grid_blocks(points: DataFrame, blocks: DataFrame, width: float, height: float, x="x", y="y") -> DataFrame:
    """Points inherit the columns of their half-open grid block; points outside all blocks drop."""
    a = with_row(points, _origin(blocks, width, height))
    a = a.withColumns({"bcol": grid_index(F.col(x), F.col("_x0"), width), "brow": grid_index(F.col(y), F.col("_y0"), height)})
    return a.drop("_x0", "_y0").join(blocks.drop(*BOX), ["bcol", "brow"])


def zonal_mean(zones: DataFrame, cells: DataFrame, value: str, res: float, zone_keys: list[str], out: str = "mean"):
    """Mean of the cells whose centre lies in each zone's bounding box.

    Only the keys of the zones travel with the cells, and the mean is combined map-side before its shuffle.
    """
    centres = cells.select(
        ((F.col("cx") + 0.5) * res).alias("_px"), ((F.col("cy") + 0.5) * res).alias("_py"), F.col(value).alias("_v")
    )
    pairs = points_in_boxes(centres, zones.select(*zone_keys, *BOX), "_px", "_py")
    return pairs.groupBy(*zone_keys).agg(F.avg("_v").alias(out))


def box_cells(df: DataFrame, res: float, box=BOX) -> DataFrame:
    """One row per grid cell whose centre lies in the box (half-open).

    The few boxes are dealt over the cluster before they turn into many cells.
    """
    df = df.repartition(worker_partitions(df.sparkSession), *box)
    xmin, ymin, xmax, ymax = (F.col(c) for c in box)
    first = lambda v: F.ceil(v / res - 0.5)
    df = df.where((first(xmax) > first(xmin)) & (first(ymax) > first(ymin)))
    return df.withColumn("cx", F.explode(F.sequence(first(xmin), first(xmax) - 1))).withColumn(
        "cy", F.explode(F.sequence(first(ymin), first(ymax) - 1))
    )


def cells_minus_boxes(tiles: DataFrame, water: DataFrame, key: str, res: float = 10.0) -> DataFrame:
    """Overlay difference on cells: cells of each tile that no water box covers (overlapping water counts once).

    Water is cut to the tile before it is spread over cells, so one large lake does not become one huge row group.
    """
    common = bucket_pairs(tiles.select(key, *BOX), water.select(*BOX), open_edges=True).select(
        key,
        F.greatest("xmin_l", "xmin_r").alias("xmin"), F.greatest("ymin_l", "ymin_r").alias("ymin"),
        F.least("xmax_l", "xmax_r").alias("xmax"), F.least("ymax_l", "ymax_r").alias("ymax"),
    )
    wet = box_cells(common, res).select(key, "cx", "cy")
    return box_cells(tiles.select(key, *BOX), res).select(key, "cx", "cy").join(wet, [key, "cx", "cy"], "left_anti")


def cells_minus_polygons(tiles: DataFrame, water: DataFrame, key: str, geom: str, res: float = 10.0) -> DataFrame:
    """As ``cells_minus_boxes`` for any polygons: a cell is wet when its centre lies in a polygon.

    A polygon meets the tiles as cells of a cover, each with its own few edges, and no smaller than some cells of the raster,
    so that their number follows the raster and not the cover.
    """
    shapes = polygon_cells(water, geom, [], most=FEW, least=WET_CELLS * res).withColumns(cell_box())
    common = bucket_pairs(tiles.select(key, *BOX), shapes, open_edges=True).select(
        key, "lvl", "ix", "full", "ref", "edges",
        F.greatest("xmin_l", "xmin_r").alias("xmin"), F.greatest("ymin_l", "ymin_r").alias("ymin"),
        F.least("xmax_l", "xmax_r").alias("xmax"), F.least("ymax_l", "ymax_r").alias("ymax"),
    )
    wet = box_cells(common, res).where(in_cell((F.col("cx") + 0.5) * res, (F.col("cy") + 0.5) * res))
    return (
        box_cells(tiles.select(key, *BOX), res)
        .select(key, "cx", "cy")
        .join(wet.select(key, "cx", "cy"), [key, "cx", "cy"], "left_anti")
    )


def sample_cells(points: DataFrame, raster: DataFrame, res: float, x="x", y="y", how: str = "left") -> DataFrame:
    """Value of the cell each point falls in; ``raster`` carries ``cx, cy`` and its value columns."""
    keyed = points.withColumns({"cx": F.floor(F.col(x) / res), "cy": F.floor(F.col(y) / res)})
    return keyed.join(raster, ["cx", "cy"], how)


def clip_cells(cells: DataFrame, polygons: DataFrame, geom: str, res: float, value: str, nodata: float | None = None):
    """Clip a raster to polygons, cropped to their bounds.

    Cells whose centre is outside become ``nodata``, or are left out when ``nodata`` is None.
    """
    centre = cells.withColumns({"_px": (F.col("cx") + 0.5) * res, "_py": (F.col("cy") + 0.5) * res})
    bounds = polygons.agg(*[F.min(c).alias(f"_{c}") for c in BOX[:2]], *[F.max(c).alias(f"_{c}") for c in BOX[2:]])
    crop = with_row(centre, bounds).where(
        (F.col("_px") >= F.col("_xmin")) & (F.col("_px") <= F.col("_xmax"))
        & (F.col("_py") >= F.col("_ymin")) & (F.col("_py") <= F.col("_ymax"))
    ).drop("_xmin", "_ymin", "_xmax", "_ymax")
    inside = (
        points_in_polygons(crop.select("cx", "cy", "_px", "_py"), polygons.select(geom, *BOX), geom, "_px", "_py")
        .select("cx", "cy")
        .distinct()
    )
    if nodata is None:
        return crop.join(inside, ["cx", "cy"], "left_semi").drop("_px", "_py")
    kept = crop.join(inside.withColumn("_in", F.lit(True)), ["cx", "cy"], "left")
    return kept.withColumn(value, F.when(F.col("_in"), F.col(value)).otherwise(F.lit(nodata))).drop("_in", "_px", "_py")
