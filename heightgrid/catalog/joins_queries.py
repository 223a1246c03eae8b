"""Spatial and key joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from heightgrid.catalog.filters_queries import _DRY, diamond, site_geoms
from heightgrid.catalog.registry import query
from heightgrid.functions import geometry as geo
from heightgrid.operators import spatial_join as sj
from heightgrid.operators.joins import attach_by_id, sample_points
from heightgrid.operators.spatial_join import BOX
from heightgrid.sources.outputs import pending

# distance in L1 from a diamond's centre to a box, at most its half width
_MEET = """greatest(t.xmin - s.px, 0, s.px - t.xmax) + greatest(t.ymin - s.py, 0, s.py - t.ymax) <= s.half"""


def tile_geoms(t):
    return t.tiles.select("tile_id", "tile_name", geo.box_geom().alias("t_geom"), *BOX)


@query("c1_tiles_sites", f"SELECT t.tile_id, s.site_id FROM tiles t JOIN sites s ON {_MEET}")
def c1(t):
    pairs = sj.spatial_join(tile_geoms(t), site_geoms(t).select("site_id", "geom", *BOX), "t_geom", "geom")
    return pairs.select("tile_id", "site_id")


@query("c1_water_sites", f"SELECT t.id, s.site_id FROM water t JOIN sites s ON {_MEET}")
def c1_water(t):
    """As above between small features of mixed size, where nothing is small enough to broadcast at scale."""
    water = t.water.select("id", geo.box_geom().alias("w_geom"), *BOX)
    pairs = sj.spatial_join(water, site_geoms(t).select("site_id", "geom", *BOX), "w_geom", "geom")
    return pairs.select("id", "site_id")


@query(
    "c2_semi_join_union",
    f"""SELECT tile_id, round(xmin, 3) AS xmin, round(ymin, 3) AS ymin FROM tiles t
        WHERE EXISTS (SELECT 1 FROM sites s WHERE s.site_name = 'BUILDING' AND {_MEET})""",
)
def c2(t):
    """Tiles arrive in degrees, are reprojected, and kept when they meet the union of the other layer."""
    from heightgrid.functions.crs import reproject_geom

    degrees = tile_geoms(t).select("tile_id", reproject_geom(F.col("t_geom"), 32633, 4326).alias("g"))
    back = degrees.select("tile_id", reproject_geom(F.col("g"), 4326, 32633).alias("t_geom"))
    # coordinates come back within a micrometre; snap them to the millimetre grid of the store
    snapped = F.transform(
        F.col("t_geom.parts"),
        lambda p: F.transform(p, lambda r: F.transform(r, lambda v: geo.vertex(F.round(v["x"], 3), F.round(v["y"], 3)))),
    )
    back = back.select("tile_id", geo.geometry("POLYGON", snapped).alias("t_geom"))
    back = back.withColumns({c: geo.bbox("t_geom")[c] for c in BOX})
    other = site_geoms(t).where("site_name = 'BUILDING'")
    out = sj.spatial_semi_join(back, other.select("geom", *BOX), ["tile_id"], "t_geom", "geom")
    return out.select("tile_id", "xmin", "ymin")


@query("c3_overlay_tiles_blocks", "SELECT tile_id, bcol, brow, folds, xmin, ymin, xmax, ymax, (xmax - xmin) * (ymax - ymin) AS area FROM tile_blocks")
def c3(t):
    return t.tile_blocks.select(
        "tile_id", "bcol", "brow", "folds", *BOX, ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area")
    )


@query(
    "c3_overlay_sites_tiles",
    """WITH p AS (SELECT s.site_id, t.tile_id, s.half,
                   least(t.xmax - s.px, s.half) AS x2, greatest(t.xmin - s.px, -s.half) AS x1,
                   least(t.ymax - s.py, s.half) AS y2, greatest(t.ymin - s.py, -s.half) AS y1
                 FROM sites s JOIN tiles t ON t.xmin < s.px + s.half AND t.xmax > s.px - s.half
                                          AND t.ymin < s.py + s.half AND t.ymax > s.py - s.half),
            -- area of the diamond within a quadrant-shaped window, by inclusion and exclusion over the four corners
            q AS (SELECT site_id, tile_id, g.sign, half, g.a AS a, g.b AS b FROM p,
                    LATERAL (SELECT 1 AS sign, x2 AS a, y2 AS b UNION ALL SELECT -1, x1, y2 UNION ALL SELECT -1, x2, y1
                             UNION ALL SELECT 1, x1, y1) g),
            -- F(a, b): area of {|x| + |y| <= h, x <= a, y <= b}
            f AS (SELECT site_id, tile_id, sign,
                    CASE WHEN abs(a) + abs(b) >= half THEN
                      CASE WHEN a >= 0 AND b >= 0 THEN 2 * half * half - (half - a) * (half - a) - (half - b) * (half - b)
                           WHEN a >= 0 THEN (half + b) * (half + b) WHEN b >= 0 THEN (half + a) * (half + a) ELSE 0 END
                    ELSE half * half / 2 + half * (a + b) + a * b - (a * abs(a) + b * abs(b)) / 2 END AS v FROM q)
       SELECT site_id, tile_id, round(sum(sign * v), 4) AS area FROM f GROUP BY site_id, tile_id HAVING sum(sign * v) > 0.00001""",
)
def c3_polygons(t):
    """Polygons clipped to tiles: one row per pair with common area."""
    pairs = sj.bucket_pairs(site_geoms(t).select("site_id", "geom", *BOX), t.tiles.select("tile_id", *BOX), open_edges=True)
    clipped = geo.area(geo.clip_to_box("geom", "xmin_r", "ymin_r", "xmax_r", "ymax_r"))
    return pairs.select("site_id", "tile_id", clipped.alias("area")).where("area > 0.00001").withColumn("area", F.round("area", 4))


@query(
    "c4_points_in_polygons",
    """SELECT s.site_id, count(*) AS n, round(sum(p.z), 4) AS sum_z FROM points p JOIN sites s
       ON abs(p.x - (s.px + 0.3)) + abs(p.y - s.py) <= s.half GROUP BY s.site_id""",
)
def c4(t):
    """Points joined to every polygon that holds them (polygons shifted so that no point is on a border)."""
    sites = t.sites.withColumn("px", F.col("px") + F.lit(0.3)).withColumn("geom", diamond())
    sites = sites.withColumns({c: geo.bbox("geom")[c] for c in BOX}).select("site_id", "geom", *BOX)
    pairs = sj.points_in_polygons(t.points.select("x", "y", "z"), sites, "geom")
    return pairs.groupBy("site_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("z"), 4).alias("sum_z"))


@query(
    "c4_i8_points_fold",
    """SELECT s.id, s.height, b.folds, b.bcol, b.brow FROM samples s
       JOIN blocks b ON s.x >= b.xmin AND s.x < b.xmax AND s.y >= b.ymin AND s.y < b.ymax""",
)
def c4_fold(t):
    """Points inherit the fold of their block."""
    return sj.points_to_grid_blocks(t.samples, t.blocks, 250.0, 250.0).select("id", "height", "folds", "bcol", "brow")


@query("c5_tiles_minus_water", _DRY + "SELECT tile_id, area FROM a")
def c5(t):
    dry = sj.cells_minus_boxes(t.tiles, t.water.where("geom_type = 'POLYGON'"), "tile_id", 10.0)
    return dry.groupBy("tile_id").agg((F.count(F.lit(1)) * 100.0).alias("area"))


@query(
    "c5_tiles_minus_sites",
    """SELECT t.tile_id, count(*) AS n FROM tiles t,
         LATERAL (SELECT unnest(range(CAST(t.xmin / 10 AS BIGINT), CAST(t.xmax / 10 AS BIGINT))) AS cx) x,
         LATERAL (SELECT unnest(range(CAST(t.ymin / 10 AS BIGINT), CAST(t.ymax / 10 AS BIGINT))) AS cy) y
       WHERE NOT EXISTS (SELECT 1 FROM sites s WHERE abs(cx * 10 + 5 - (s.px + 0.3)) + abs(cy * 10 + 5 - s.py) <= s.half)
       GROUP BY t.tile_id""",
)
def c5_polygons(t):
    """Difference with general polygons on cell centres."""
    sites = t.sites.withColumn("px", F.col("px") + F.lit(0.3)).withColumn("geom", diamond())
    sites = sites.withColumns({c: geo.bbox("geom")[c] for c in BOX}).select("geom", *BOX)
    dry = sj.cells_minus_polygons(t.tiles, sites, "tile_id", "geom", 10.0)
    return dry.groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"))


@query("c6_zonal_cover", "SELECT tile_id, cover FROM tile_cover")
def c6(t):
    return t.tile_cover.select("tile_id", "cover")


@query(
    "c7_sample_raster",
    """SELECT c.site_id, h.height FROM (SELECT site_id, CAST(floor(px / 10) AS BIGINT) AS cx, CAST(floor(py / 10) AS BIGINT) AS cy FROM sites) c
       LEFT JOIN chm h USING (cx, cy)""",
)
def c7(t):
    """Height at the centroid of each area; no data where no cell is."""
    g = site_geoms(t).select("site_id", geo.centroid("geom").alias("c"))
    at = g.select("site_id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))
    return sj.sample_cells(at, t.chm.select("cx", "cy", "height"), 10.0).select("site_id", "height")


@query(
    "c8_join_embeddings",
    """SELECT s.id, s.height, s.strata, e.strata AS strata_embeddings, e.a0 FROM samples s LEFT JOIN (
         SELECT md5(concat(tile_id, '|', cx, '|', cy)) AS id, label AS strata, embedding[1] AS a0 FROM emb_px WHERE cx % 3 <> 0) e USING (id)""",
)
def c8(t):
    """Left join on id; clashing names of the right side get a suffix."""
    e = t.emb_px.where("cx % 3 <> 0").selectExpr(
        "md5(concat(tile_id, '|', cx, '|', cy)) AS id", "label AS strata", "embedding[0] AS a0"
    )
    return attach_by_id(t.samples.select("id", "height", "strata"), e, "id")


@query(
    "c9_pending",
    "SELECT tile_id, tile_name FROM tiles WHERE tile_id NOT IN (SELECT tile_id FROM points WHERE hag > 58.4)",
)
def c9(t):
    done = t.points.where("hag > 58.4").select("tile_id").distinct()
    return pending(t.tiles.select("tile_id", "tile_name"), done, ["tile_id"])


@query(
    "c10_sample_bands",
    """SELECT s.id, e.vec_id, list_sum(list_transform(e.embedding, lambda v: round(CAST(v AS DOUBLE) * 1000))) AS checksum
       FROM samples s JOIN emb_px e ON e.cx = CAST(floor(s.x / 10) AS BIGINT) AND e.cy = CAST(floor(s.y / 10) AS BIGINT)""",
)
def c10(t):
    """All 64 bands at the sample points; points without data drop."""
    out = sample_points(t.samples.select("id", "x", "y"), t.emb_px.select("cx", "cy", "vec_id", "embedding"), 10.0)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + F.round(v.cast("double") * 1000))
    return out.select("id", "vec_id", total.alias("checksum"))


_CLIP = """(SELECT min(s.px + 0.3 - s.half) AS x1, max(s.px + 0.3 + s.half) AS x2, min(s.py - s.half) AS y1, max(s.py + s.half) AS y2
             FROM sites s WHERE s.site_name = 'MACHINERY')"""
_IN_CLIP = """EXISTS (SELECT 1 FROM sites s WHERE s.site_name = 'MACHINERY'
                     AND abs(c.cx * 10 + 5 - (s.px + 0.3)) + abs(c.cy * 10 + 5 - s.py) <= s.half)"""


@query(
    "c11_clip_raster",
    f"""SELECT c.cx, c.cy, CASE WHEN {_IN_CLIP} THEN c.height ELSE -9999 END AS height FROM chm c CROSS JOIN {_CLIP} b
        WHERE c.cx * 10 + 5 BETWEEN b.x1 AND b.x2 AND c.cy * 10 + 5 BETWEEN b.y1 AND b.y2""",
)
def c11(t):
    return sj.clip_cells(t.chm.select("cx", "cy", "height"), _clip_layer(t), "geom", 10.0, "height", -9999.0)


@query("c11_clip_raster_sparse", f"SELECT c.cx, c.cy, c.height FROM chm c WHERE {_IN_CLIP}")
def c11_sparse(t):
    return sj.clip_cells(t.chm.select("cx", "cy", "height"), _clip_layer(t), "geom", 10.0, "height")


def _clip_layer(t):
    s = t.sites.where("site_name = 'MACHINERY'").withColumn("px", F.col("px") + F.lit(0.3))
    s = s.withColumn("geom", diamond())
    return s.withColumns({c: geo.bbox("geom")[c] for c in BOX}).select("geom", *BOX)


@query(
    "h26_k4_clip_polygon",
    """SELECT site_id, round(CASE WHEN half <= 40 THEN half * half ELSE half * half - (half - 40) * (half - 40) END, 4) AS area FROM sites""",
)
def k4(t):
    """Each diamond clipped to the half plane strip ``px <= x <= px + 40``."""
    c = geo.clip_to_box("geom", F.col("px"), F.col("py") - 1000, F.col("px") + 40, F.col("py") + 1000)
    return site_geoms(t).select("site_id", F.round(geo.area(c), 4).alias("area"))
