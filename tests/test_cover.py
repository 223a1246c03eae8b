"""Polygon cell cover, nearest ground over blocks, and the ground filter's windows, against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heightgrid.functions import geometry as geo
from heightgrid.operators import cover, ground
from heightgrid.operators.spatial_join import points_in_polygons


def ring(rng, n, cx, cy, r, step=None):
    """A star-shaped ring; coordinates on a coarse lattice when ``step`` is given, so that many fall on cell sides."""
    angles = sorted(rng.uniform(0, 2 * np.pi) for _ in range(n))
    points = [(cx + r * rng.uniform(0.3, 1) * np.cos(a), cy + r * rng.uniform(0.3, 1) * np.sin(a)) for a in angles]
    if step:
        points = [(round(x / step) * step, round(y / step) * step) for x, y in points]
    return [*points, points[0]]


def inside(rings, x, y):
    """Ray casting over all edges; left and lower borders are inside."""
    odd = False
    for points in rings:
        for (x1, y1), (x2, y2) in zip(points, points[1:], strict=False):
            if (y1 > y) != (y2 > y):
                odd ^= x < x1 + (x2 - x1) / (y2 - y1) * (y - y1)
    return odd


@pytest.fixture(scope="module")
def polygons(spark):
    rng = random.Random(11)
    shapes = [[ring(rng, 9, rng.uniform(-50, 50), rng.uniform(-50, 50), rng.uniform(2, 40))] for _ in range(40)]
    shapes += [[ring(rng, 12, 0, 0, 32, step=4.0)] for _ in range(20)]
    shapes.append([ring(rng, 400, 10, -5, 60)])  # many edges in one cell
    shapes.append([[(-64, -64), (64, -64), (64, 64), (-64, 64), (-64, -64)], [(-32, -32), (-32, 32), (32, 32), (32, -32), (-32, -32)]])  # a hole, on cell sides
    rows = [(i, [[[(float(x), float(y)) for x, y in points] for points in rings]], "clash") for i, rings in enumerate(shapes)]
    df = spark.createDataFrame(rows, f"id int, parts array<array<array<{geo.VERTEX}>>>, full string")
    df = df.withColumn("geom", geo.geometry("POLYGON", F.col("parts"))).drop("parts", "full")
    return shapes, df.withColumns({c: geo.bbox("geom")[c] for c in cover.BOX})


def test_points_meet_polygons_as_by_ray_casting(spark, polygons):
    shapes, df = polygons
    rng = random.Random(3)
    places = [(rng.uniform(-70, 70), rng.uniform(-70, 70)) for _ in range(1500)]
    places += [(4.0 * rng.randrange(-17, 17), 4.0 * rng.randrange(-17, 17)) for _ in range(500)]
    pts = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(places)], "k int, x double, y double")
    got = {(r.k, r.id) for r in points_in_polygons(pts, df, "geom").select("k", "id").collect()}
    assert got == {(k, i) for k, (x, y) in enumerate(places) for i, rings in enumerate(shapes) if inside(rings, x, y)}


def test_cells_partition_the_polygon(polygons):
    shapes, df = polygons
    cells = cover.polygon_cells(df, "geom", ["id"])
    rows = cells.select("id", "lvl", "ix", "iy", "full", F.size("edges").alias("n")).collect()
    assert len({(r.id, r.lvl, r.ix, r.iy) for r in rows}) == len(rows)
    assert all((r.n == 0) == r.full and (r.n <= 2 or r.lvl == cover.LEAST_LEVEL) for r in rows)
    square = len(shapes) - 1
    fine = cover.polygon_cells(df.where(F.col("id") == square), "geom", [], depth=5)
    full = sum(4.0**r.lvl for r in fine.where("full").select("lvl").collect())
    assert 0.5 * (128**2 - 64**2) <= full <= 128**2 - 64**2
    crowded = cover.polygon_cells(df, "geom", ["id"], depth=0, most=10**9).groupBy("id").count().agg(F.max("count")).first()[0]
    assert crowded <= 9


def test_polygons_without_edges(spark, polygons):
    _, df = polygons
    nothing = df.limit(2).withColumn("geom", F.when(F.col("id") > 0, geo.geometry("POLYGON", F.array().cast(f"array<array<array<{geo.VERTEX}>>>"))))
    assert cover.polygon_cells(nothing, "geom", ["id"]).count() == 0
    assert cover.polygon_cells(df.limit(0), "geom", ["id"]).count() == 0


def nearest(places, grounds):
    out = {}
    for k, x, y in places:
        near = [((x - gx) ** 2 + (y - gy) ** 2, gz) for g, gx, gy, gz in grounds if g == k]
        if near:
            out[k, x, y] = min(near)
    return out


def test_nearest_ground_far_away(spark, monkeypatch):
    """Ground in one corner of a tile, another tile without ground, one with a single place, negative coordinates."""
    rng = random.Random(8)
    places = {(1, 0.5 * rng.randrange(-200, 1800), 0.5 * rng.randrange(-200, 1800)) for _ in range(500)}
    places |= {(2, float(rng.randrange(400)), float(rng.randrange(400))) for _ in range(50)} | {(3, 7.0, 7.0)}
    grounds = {(1, 0.5 * rng.randrange(1700, 1800), 0.5 * rng.randrange(-200, -100)): float(i % 7) for i in range(60)} | {(3, 900.0, -900.0): 1.0}
    rows = [(*k, z) for k, z in grounds.items()]
    p = spark.createDataFrame(sorted(places), "tile_id long, x double, y double")
    g = spark.createDataFrame(rows, "tile_id long, x double, y double, z double")
    handed = []
    blocks = ground.block_pairs

    def counted(q, gr, key):
        handed.append(blocks(q, gr, key))
        return handed[-1]

    monkeypatch.setattr(ground, "block_pairs", counted)
    got = {(r.tile_id, r.x, r.y): (r.d2, r.gz) for r in ground.nearest_ground(p, g).collect()}
    assert got == nearest(places, rows)
    assert handed[0].count() < 20 * p.count()
    assert ground.nearest_ground(p, g.limit(0)).count() == 0
    assert ground.nearest_ground(p.limit(0), g).count() == 0


def test_ground_filter_keeps_slopes_and_does_not_depend_on_windows(spark):
    """Planted slopes of 5 percent with boxes of 8 m on them: the boxes go, the slope stays, for any window."""
    rng = np.random.default_rng(2)
    x, y = np.meshgrid(np.arange(0.5, 90), np.arange(0.5, 70))
    x, y = x.ravel(), y.ravel()
    z = 100 + 0.05 * x + 0.03 * y + rng.normal(0, 0.02, len(x))
    roof = np.zeros(len(x), bool)
    for cx, cy in ((15, 15), (45, 30), (70, 55)):
        roof |= (abs(x - cx) < 4) & (abs(y - cy) < 4)
    z = np.where(roof, z + 6, z)
    rows = [(1, float(a), float(b), float(c)) for a, b, c in zip(x, y, z, strict=True)]
    df = spark.createDataFrame(rows, "tile_id long, x double, y double, z double")
    seen = []
    for span in (512, 40, 17):
        got = {(r.x, r.y): r.classification for r in ground.classify_ground(df, span=span).collect()}
        seen.append(got)
        marked = np.array([got[a, b] for a, b in zip(x.tolist(), y.tolist(), strict=True)]) == 2
        assert not marked[roof].any() and marked[~roof].mean() > 0.95
    assert seen[0] == seen[1] == seen[2]
