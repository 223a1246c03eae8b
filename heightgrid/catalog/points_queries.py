"""Point clouds: scans, stages, height grids, ground."""

from __future__ import annotations

from pyspark.sql import functions as F

from heightgrid.catalog.registry import query
from heightgrid.functions.geometry import polygon_from_xy
from heightgrid.operators import points as pt
from heightgrid.operators.grid import cell_key, stratify
from heightgrid.operators.ground import classify_ground, height_above_ground
from heightgrid.settings import HEIGHT_EDGES

KEYS = "tile_id, l_orderkey, l_linenumber, l_partkey, x, y"


@query(
    "height_by_stratum",
    """SELECT strata, count(*) AS n_cells, round(avg(height), 6) AS mean_height
       FROM strata_px GROUP BY strata""",
)
def height_by_stratum(t):
    """Flagship: points to 95th percentile grid, strata, and mean height per stratum."""
    grid = pt.height_grid(t.points, "P95", max_height=50.0)
    return stratify(grid, "height", HEIGHT_EDGES).groupBy("strata").agg(
        F.count(F.lit(1)).alias("n_cells"), F.round(F.avg("height"), 6).alias("mean_height")
    )


@query("a6_bbox_scan", f"SELECT {KEYS}, z FROM points WHERE x BETWEEN 500120 AND 500680 AND y BETWEEN 6500010 AND 6500090")
def a6(t):
    return pt.in_bounds(t.points, 500120, 6500010, 500680, 6500090).selectExpr(*KEYS.split(", "), "z")


@query(
    "a7_polygon_scan",
    f"SELECT {KEYS}, z FROM points WHERE abs(x - 500400) + abs(y - 6500040) < 300.25",
)
def a7(t):
    """Points of one diamond; no point lies on its border."""
    ring = polygon_from_xy([(F.lit(float(x)), F.lit(float(y))) for x, y in
                            [(500099.75, 6500040), (500400, 6499739.75), (500700.25, 6500040), (500400, 6500340.25)]])
    return pt.in_polygon(t.points, ring, (500099.75, 6499739.75, 500700.25, 6500340.25)).selectExpr(*KEYS.split(", "), "z")


@query("b13_range", f"SELECT {KEYS}, hag FROM points WHERE hag >= 0 AND hag <= 50")
def b13(t):
    return pt.in_range(t.points, "hag", 0, 50).selectExpr(*KEYS.split(", "), "hag")


@query("b14_expression", f"SELECT {KEYS}, z FROM points WHERE classification = 2 OR (z - ground_z > 12.5 AND cx % 3 = 1)")
def b14(t):
    text = "classification = 2 OR (z - ground_z > 12.5 AND cx % 3 = 1)"
    return pt.matching(t.points, text).selectExpr(*KEYS.split(", "), "z")


@query("b15_ground", f"SELECT {KEYS}, z FROM points WHERE classification = 2")
def b15(t):
    return pt.ground_only(t.points).selectExpr(*KEYS.split(", "), "z")


@query(
    "d1_p95_grid",
    """SELECT tile_id, cx, cy, round(quantile_cont(hag, 0.95), 6) AS height, count(*) AS n
       FROM points WHERE hag BETWEEN 0 AND 50 GROUP BY tile_id, cx, cy""",
)
def d1(t):
    return pt.height_grid(t.points, "P95", max_height=50.0)


@query(
    "d2_statistic_grid",
    """SELECT 'min' AS statistic, tile_id, cx, cy, round(min(hag), 6) AS height, count(*) AS n FROM points GROUP BY ALL
       UNION ALL SELECT 'max', tile_id, cx, cy, round(max(hag), 6), count(*) FROM points GROUP BY ALL
       UNION ALL SELECT 'mean', tile_id, cx, cy, round(avg(hag), 6), count(*) FROM points GROUP BY ALL
       UNION ALL SELECT 'count', tile_id, cx, cy, CAST(count(*) AS DOUBLE), count(*) FROM points GROUP BY ALL
       UNION ALL SELECT 'stdev', tile_id, cx, cy, round(stddev_samp(hag), 6), count(*) FROM points GROUP BY ALL
       UNION ALL SELECT 'p50', tile_id, cx, cy, round(quantile_cont(hag, 0.5), 6), count(*) FROM points GROUP BY ALL""",
)
def d2(t):
    out = None
    for name in ("min", "max", "mean", "count", "stdev", "p50"):
        part = pt.height_grid(t.points, name).select(F.lit(name).alias("statistic"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "g2_merge_clouds",
    f"""SELECT {KEYS}, z, CAST(NULL AS DOUBLE) AS hag FROM points WHERE classification = 2
        UNION ALL SELECT {KEYS}, z, hag FROM points WHERE classification = 5""",
)
def g2(t):
    cols = KEYS.split(", ")
    ground = pt.ground_only(t.points).select(*cols, "z")
    rest = t.points.where("classification = 5").select(*cols, "z", "hag")
    return pt.merge_clouds([ground, rest])


@query(
    "j5_cell_key",
    f"""SELECT {KEYS}, CAST(floor((x - 500003.5) / 7.5) AS BIGINT) AS gx,
               CAST(floor((y - 6500002.25) / 7.5) AS BIGINT) AS gy FROM points""",
)
def j5(t):
    gx, gy = cell_key("x", "y", 7.5, 500003.5, 6500002.25)
    return t.points.select(*KEYS.split(", "), gx.alias("gx"), gy.alias("gy"))


@query(
    "j8_stages",
    """SELECT tile_id, cx, cy, round(max(hag), 6) AS height, count(*) AS n FROM points
       WHERE hag BETWEEN 1 AND 45 AND cx % 2 = 0 GROUP BY tile_id, cx, cy""",
)
def j8(t):
    stages = [
        lambda d: pt.in_range(d, "hag", 1, 45),
        lambda d: pt.matching(d, "cx % 2 = 0"),
        lambda d: pt.height_grid(d, "max"),
    ]
    return pt.run_stages(t.points, stages)


@query("j9_ground_filter")
def j9(t):
    """Ground classification of the raw elevations; the test plants surfaces instead of an oracle."""
    return classify_ground(t.points.drop("classification", "hag", "ground_z")).groupBy(
        "tile_id", "classification"
    ).agg(F.count(F.lit(1)).alias("n_points"))


@query(
    "j10_height_above_ground",
    """WITH g AS (SELECT tile_id, x, y, min(z) AS gz FROM points WHERE classification = 2 GROUP BY ALL),
            q AS (SELECT DISTINCT tile_id, x, y FROM points),
            best AS (SELECT q.tile_id, q.x, q.y,
                            min({'d2': (g.x - q.x) * (g.x - q.x) + (g.y - q.y) * (g.y - q.y), 'gz': g.gz}) AS m
                     FROM q JOIN g USING (tile_id) GROUP BY ALL)
       SELECT p.tile_id, p.l_orderkey, p.l_linenumber, p.l_partkey, p.x, p.y, round(p.z - b.m.gz, 6) AS hag
       FROM points p LEFT JOIN best b USING (tile_id, x, y)""",
)
def j10(t):
    pts = t.points.drop("hag", "ground_z")
    return height_above_ground(pts).select(*KEYS.split(", "), F.round("hag", 6).alias("hag"))


@query(
    "c13_ground_distance",
    """WITH g AS (SELECT DISTINCT tile_id, x, y FROM points WHERE classification = 2),
            q AS (SELECT DISTINCT tile_id, x, y FROM points)
       SELECT q.tile_id, q.x, q.y, round(min((g.x - q.x) * (g.x - q.x) + (g.y - q.y) * (g.y - q.y)), 6) AS d2
       FROM q JOIN g USING (tile_id) GROUP BY q.tile_id, q.x, q.y""",
)
def c13(t):
    """Nearest-ground join: squared distance from every place to the nearest ground place of its tile."""
    from heightgrid.operators.ground import nearest_ground

    ground = pt.ground_only(t.points).groupBy("tile_id", "x", "y").agg(F.min("z").alias("z"))
    near = nearest_ground(t.points.select("tile_id", "x", "y").distinct(), ground)
    return near.select("tile_id", "x", "y", F.round("d2", 6).alias("d2"))
