import numpy as np
import pytest
from pyspark.sql import functions as F

from heightgrid.operators import points as pt
from heightgrid.operators.grid import stratify
from heightgrid.operators.ground import classify_ground, height_above_ground
from heightgrid.settings import HEIGHT_EDGES

KNOWN_POINTS = """
SELECT 0 AS tile_id, x, y, CASE WHEN l_returnflag = 'N' THEN CAST(0 AS DOUBLE)
   ELSE least(CAST(floor(abs((x - 500000) % 400 - 200) / 200 * 35) AS DOUBLE) + l_quantity / 2, CAST(60 AS DOUBLE)) END AS hag
FROM (SELECT *, 500000 + (l_partkey * 37 + l_linenumber * 11 + l_orderkey * 3) % 1000 + CAST(0.5 AS DOUBLE) AS x,
             6500000 + (l_orderkey * 53 + l_suppkey * 7) % 1000 + CAST(0.5 AS DOUBLE) AS y FROM {lineitem}) t
"""


def test_published_grid_values(spark):
    """Cells, sum and strata counts known for these points at scale 0.01."""
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    grid = pt.height_grid(spark.sql(KNOWN_POINTS, lineitem=li), "P95", max_height=50.0)
    r = grid.agg(F.count("*").alias("n"), F.round(F.sum("height"), 6).alias("s"), F.min("n").alias("lo"), F.max("n").alias("hi")).first()
    assert tuple(r) == (9968, 329730.425, 1, 17)
    strata = {r["strata"]: r["count"] for r in stratify(grid, "height", HEIGHT_EDGES).groupBy("strata").count().collect()}
    assert [strata.get(s, 0) for s in range(1, 11)] == [13, 98, 228, 609, 1219, 1397, 1446, 1539, 1683, 1527]


def test_unknown_statistic(spark):
    with pytest.raises(ValueError):
        pt.height_grid(spark.createDataFrame([(1, 0.0, 0.0, 1.0)], "tile_id int, x double, y double, hag double"), "median?")


def test_empty_bounds_give_empty_table(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0)], "tile_id int, x double, y double")
    assert pt.in_bounds(df, 5, 5, 6, 6).count() == 0


def test_height_above_ground_against_brute_force(spark):
    rng = np.random.default_rng(1)
    n = 400
    # tile 1: ground in one corner only, so most blocks hold none; tile 2: no ground at all
    xy = rng.uniform(0, 300, (n, 2)).round(2)
    cls = np.where((xy < 60).all(axis=1), 2, 1)
    z = rng.uniform(0, 50, n).round(2)
    rows = [(1, float(a), float(b), float(c), int(k)) for (a, b), c, k in zip(xy, z, cls)]
    rows += [(2, 1.0, 1.0, 5.0, 1)]
    df = spark.createDataFrame(rows, "tile_id long, x double, y double, z double, classification int")
    got = {(r["tile_id"], r["x"], r["y"]): r["hag"] for r in height_above_ground(df).collect()}
    g = xy[cls == 2]
    gz = z[cls == 2]
    for (x, y), c in zip(xy, z):
        d2 = (g[:, 0] - x) ** 2 + (g[:, 1] - y) ** 2
        assert got[(1, float(x), float(y))] == pytest.approx(c - gz[d2.argmin()], abs=1e-9)
    assert got[(2, 1.0, 1.0)] is None


def test_ground_filter_on_planted_surface(spark):
    """A gentle slope with a block of 6 m x 6 m standing 8 m high: the block is no ground, the slope is."""
    rows = []
    for x in range(60):
        for y in range(60):
            block = 20 <= x < 26 and 20 <= y < 26
            rows.append((1, x + 0.5, y + 0.5, 0.05 * x + (8.0 if block else 0.0), block))
    df = spark.createDataFrame(rows, "tile_id long, x double, y double, z double, block boolean")
    out = classify_ground(df)
    wrong = out.where("block = (classification = 2)").count()
    assert wrong <= 0.01 * len(rows)
    assert out.where("block AND classification = 2").count() == 0


def test_ground_filter_is_the_same_for_one_window_and_many(spark):
    """Hills with gaps, blocks, deep pits and a lone point far away, which once made a tile too wide for one array."""
    rng = np.random.default_rng(5)
    rows = []
    for x in range(150):
        for y in range(150):
            if rng.random() < 0.2:
                continue
            z = 3 * np.sin(x / 20) + 2 * np.cos(y / 15)
            z += 9.0 * (30 <= x < 40 and 60 <= y < 75) + rng.uniform(0, 15) * (rng.random() < 0.1) - 30.0 * (rng.random() < 0.002)
            rows.append((1, x + 0.5, y + 0.5, float(z)))
    rows.append((1, 9_000_000.5, 0.5, 1.0))
    df = spark.createDataFrame(rows, "tile_id long, x double, y double, z double")
    one, many = ({(r.x, r.y): r.classification for r in classify_ground(df, span=s).collect()} for s in (512, 48))
    assert one == many and len(one) == len(rows)
    assert {2, 1} == set(one.values())


def test_a_lone_deep_pit_is_no_ground(spark):
    rows = [(1, x + 0.5, y + 0.5, -20.0 if (x, y) == (10, 10) else 0.0) for x in range(20) for y in range(20)]
    df = spark.createDataFrame(rows, "tile_id long, x double, y double, z double")
    assert [(r.x, r.y) for r in classify_ground(df).where("classification <> 2").collect()] == [(10.5, 10.5)]
