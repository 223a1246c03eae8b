"""Grid operators and coordinate systems."""

from __future__ import annotations

from pyspark.sql import functions as F

from heightgrid.catalog.filters_queries import site_geoms
from heightgrid.catalog.registry import query
from heightgrid.functions import crs
from heightgrid.operators import grid
from heightgrid.operators.spatial_join import BOX
from heightgrid.settings import HEIGHT_EDGES


@query(
    "j1_prediction_grid",
    """WITH b AS (SELECT min(px - half) AS x0, min(py - half) AS y0, max(px + half) AS x1, max(py + half) AS y1 FROM sites),
            n AS (SELECT *, CAST(ceil((x1 - x0) / 25) AS BIGINT) AS nx, CAST(ceil((y1 - y0) / 25) AS BIGINT) AS ny FROM b),
            g AS (SELECT n.*, i.bcol, j.brow, x0 + bcol * 25 AS xmin, y0 + brow * 25 AS ymin, x0 + bcol * 25 + 25 AS xmax, y0 + brow * 25 + 25 AS ymax
                  FROM n, LATERAL (SELECT unnest(range(0, nx)) AS bcol) i, LATERAL (SELECT unnest(range(0, ny)) AS brow) j)
       SELECT brow * nx + bcol AS id, bcol, brow, xmin, ymin FROM g t WHERE EXISTS (SELECT 1 FROM sites s
         WHERE greatest(t.xmin - s.px, 0, s.px - t.xmax) + greatest(t.ymin - s.py, 0, s.py - t.ymax) <= s.half)""",
)
def j1(t):
    return grid.prediction_grid(site_geoms(t), 25.0, "geom").select("id", "bcol", "brow", "xmin", "ymin")


@query(
    "j2_mesh_grid",
    """SELECT tile_id, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, xmin + c * 25 AS x1, ymax - (r + 1) * 25 AS y1, xmin + (c + 1) * 25 AS x2, ymax - r * 25 AS y2
       FROM tiles, LATERAL (SELECT unnest(range(0, 4)) AS r) a, LATERAL (SELECT unnest(range(0, 4)) AS c) b""",
)
def j2(t):
    return grid.mesh_grid(t.tiles.select("tile_id", *BOX), 4).drop(*BOX)


@query(
    "j3_mesh_by_step",
    """SELECT tile_id, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, xmin + c * 30 AS x1, ymax - (r + 1) * 45 AS y1, xmin + (c + 1) * 30 AS x2, ymax - r * 45 AS y2
       FROM tiles, LATERAL (SELECT unnest(range(0, 3)) AS r) a, LATERAL (SELECT unnest(range(0, 4)) AS c) b""",
)
def j3(t):
    return grid.mesh_by_step(t.tiles.select("tile_id", *BOX), 30, 45).drop(*BOX)


_PIX = """SELECT l_orderkey, l_linenumber, l_partkey, tile_id, '{m}' AS snap, 500000 + {f}((x - 500000) / 10) * 10 AS xmin,
  6600000 - ({f}((6600000 - y) / 10) + 1) * 10 AS ymin, 500000 + ({f}((x - 500000) / 10) + 1) * 10 AS xmax,
  6600000 - {f}((6600000 - y) / 10) * 10 AS ymax FROM points"""


@query("j4_pixel_bounds", _PIX.format(m="ceil", f="ceil") + " UNION ALL " + _PIX.format(m="floor", f="floor"))
def j4(t):
    out = None
    for snap in ("ceil", "floor"):
        b = grid.pixel_bounds("x", "y", F.lit(500000.0), F.lit(6600000.0), 10.0, snap)
        part = t.points.select("l_orderkey", "l_linenumber", "l_partkey", "tile_id", F.lit(snap).alias("snap"), b.alias("_b"))
        part = part.select("l_orderkey", "l_linenumber", "l_partkey", "tile_id", "snap", "_b.*")
        out = part if out is None else out.unionByName(part)
    return out


@query("j6_stratify", "SELECT tile_id, cx, cy, height, strata FROM strata_px")
def j6(t):
    return grid.stratify(t.chm.select("tile_id", "cx", "cy", "height"), "height", HEIGHT_EDGES)


@query(
    "j7_tile_cleanup",
    """WITH kept AS (SELECT * FROM tile_cover WHERE cover >= 0.25),
            dry AS (SELECT t.tile_id, t.cover, count(*) * 100.0 AS area FROM kept t,
                      LATERAL (SELECT unnest(range(CAST(t.xmin / 10 AS BIGINT), CAST(t.xmax / 10 AS BIGINT))) AS cx) x,
                      LATERAL (SELECT unnest(range(CAST(t.ymin / 10 AS BIGINT), CAST(t.ymax / 10 AS BIGINT))) AS cy) y
                    WHERE NOT EXISTS (SELECT 1 FROM water w WHERE w.geom_type = 'POLYGON' AND x.cx * 10 + 5 >= w.xmin AND x.cx * 10 + 5 < w.xmax
                                      AND y.cy * 10 + 5 >= w.ymin AND y.cy * 10 + 5 < w.ymax) GROUP BY t.tile_id, t.cover)
       SELECT d.tile_id, d.cover, CAST(d.area AS DOUBLE) AS area FROM dry d
       CROSS JOIN (SELECT avg(area) - 3 * stddev_samp(area) AS cut FROM dry) k WHERE d.area > k.cut""",
)
def j7(t):
    from heightgrid.plans.dataset import clean_tiles

    kept, _ = clean_tiles(t.tiles, t.forest_px, 10.0, t.water.where("geom_type = 'POLYGON'"), 0.25, 10.0)
    return kept.select("tile_id", F.round("cover", 6).alias("cover"), "area")


_NEIGH = "(VALUES (-2), (-1), (0), (1), (2)) a(d), (VALUES (-2), (-1), (0), (1), (2)) b(d)"


@query("j11_dilate", f"SELECT DISTINCT s.cx + a.d AS cx, s.cy + b.d AS cy FROM (SELECT cx, cy FROM strata_px WHERE strata = 2) s, {_NEIGH}")
def j11(t):
    return grid.dilate(t.strata_px.where("strata = 2"), 2)


@query(
    "j11_erode",
    f"""SELECT cx, cy FROM (SELECT s.cx + a.d AS cx, s.cy + b.d AS cy, count(*) AS k
        FROM (SELECT DISTINCT cx, cy FROM strata_px WHERE strata > 2) s, {_NEIGH} GROUP BY 1, 2) WHERE k = 25""",
)
def j11_erode(t):
    return grid.erode(t.strata_px.where("strata > 2"), 2)


@query(
    "j12_resample",
    """SELECT cx, cy, height FROM (SELECT DISTINCT CAST(floor(x / 4) AS BIGINT) AS cx, CAST(floor(y / 4) AS BIGINT) AS cy FROM points) k
       JOIN (SELECT cx AS sx, cy AS sy, height FROM chm) c
         ON c.sx = CAST(floor((k.cx + 0.5) * 4 / 10) AS BIGINT) AND c.sy = CAST(floor((k.cy + 0.5) * 4 / 10) AS BIGINT)""",
)
def j12(t):
    """The 10 m raster read at 4 m cells, nearest cell, by way of degrees and back."""
    targets = t.points.select(F.floor(F.col("x") / 4).alias("cx"), F.floor(F.col("y") / 4).alias("cy")).distinct()
    return grid.resample(t.chm.select("cx", "cy", "height"), ["height"], 10.0, 32633, targets, 4.0, 32633).select("cx", "cy", "height")


@query(
    "k1_utm_zone",
    """SELECT site_id, CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + least(greatest(floor((lon + 180) / 6) + 1, 1), 60) AS INTEGER) AS epsg
       FROM (SELECT site_id, (site_id * 37) % 360 - 180 + 0.25 AS lon, (site_id * 53) % 160 - 80 + 0.5 AS lat FROM sites)""",
)
def k1(t):
    s = t.sites.selectExpr("site_id", "CAST((site_id * 37) % 360 - 180 + 0.25 AS DOUBLE) AS lon", "CAST((site_id * 53) % 160 - 80 + 0.5 AS DOUBLE) AS lat")
    return s.select("site_id", crs.utm_epsg("lon", "lat").alias("epsg"))


@query(
    "k1_layer_zone",
    """SELECT CAST(32600 + floor(((min(lon) + max(lon)) / 2 + 180) / 6) + 1 AS INTEGER) AS epsg
       FROM (SELECT 12 + (site_id % 500) / 100 AS lon FROM sites)""",
)
def k1_layer(t):
    s = t.sites.selectExpr("CAST(12 + (site_id % 500) / 100 AS DOUBLE) AS lon", "CAST(50 AS DOUBLE) AS lat")
    return crs.estimate_utm(s, "lon", "lat", "lon", "lat")


# The oracle takes the classical expansion in powers of longitude (Snyder 1987), not Krueger's series.
_SNYDER = """
WITH p AS (SELECT id, radians(lat) AS f, radians(lon - 15) AS l FROM (
             SELECT p_partkey AS id, 12.5 + (p_partkey * 37 % 500) / 100.0 AS lon, 40 + (p_partkey * 53 % 3000) / 100.0 AS lat FROM part)),
 e AS (SELECT *, CAST(0.0066943799901413165 AS DOUBLE) AS e2, CAST(0.006739496742276434 AS DOUBLE) AS ep FROM p),
 q AS (SELECT *, 6378137.0 / sqrt(1 - e2 * sin(f) * sin(f)) AS n, tan(f) * tan(f) AS t, ep * cos(f) * cos(f) AS c, l * cos(f) AS a,
   6378137.0 * ((1 - e2/4 - 3*e2*e2/64 - 5*e2*e2*e2/256 - 175*e2*e2*e2*e2/16384) * f - (3*e2/8 + 3*e2*e2/32 + 45*e2*e2*e2/1024 + 105*e2*e2*e2*e2/4096) * sin(2*f)
     + (15*e2*e2/256 + 45*e2*e2*e2/1024 + 525*e2*e2*e2*e2/16384) * sin(4*f) - (35*e2*e2*e2/3072 + 175*e2*e2*e2*e2/12288) * sin(6*f) + 315*e2*e2*e2*e2/131072 * sin(8*f)) AS m FROM e)
"""


@query(
    "k2_reproject",
    _SNYDER
    + """SELECT id, round(500000 + 0.9996 * n * (a + (1 - t + c) * pow(a, 3) / 6 + (5 - 18*t + t*t + 72*c - 58*ep) * pow(a, 5) / 120), 0) AS x,
                round(0.9996 * (m + n * tan(f) * (a*a/2 + (5 - t + 9*c + 4*c*c) * pow(a, 4) / 24 + (61 - 58*t + t*t + 600*c - 330*ep) * pow(a, 6) / 720)), 0) AS y,
                round(degrees(l) + 15, 8) AS lon, round(degrees(f), 8) AS lat FROM q""",
)
def k2(t):
    """Degrees to UTM (whole metres against an independent series) and back."""
    p = t.part.selectExpr("p_partkey AS id", "12.5D + (p_partkey * 37 % 500) / 100D AS lon", "40 + (p_partkey * 53 % 3000) / 100D AS lat")
    x, y = crs.reproject_xy(F.col("lon"), F.col("lat"), 4326, 32633)
    u = p.select("id", x.alias("x"), y.alias("y"))
    lon, lat = crs.reproject_xy(F.col("x"), F.col("y"), 32633, 4326)
    return u.select("id", F.round("x", 0).alias("x"), F.round("y", 0).alias("y"), F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))


@query("k3_set_crs", "SELECT tile_id, 32633 AS srid FROM tiles")
def k3(t):
    return crs.set_crs(t.tiles.select("tile_id"), 32633)
