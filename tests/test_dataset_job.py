"""Rules of the data set job: area before year, water by polygon, heights by tile, no invalid numbers in the search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from heightgrid.functions.geometry import box_geom
from heightgrid.functions.wkb import from_wkt
from heightgrid.modeling.gram import cross_products
from heightgrid.operators.spatial_join import BOX
from heightgrid.plans import dataset
from heightgrid.settings import Settings

TILE = "tile_id long, project string, xmin double, ymin double, xmax double, ymax double"


def plan_of(spark, tiles, water, **settings):
    area = spark.createDataFrame([(0.0, 0.0, 1000.0, 1000.0)], "xmin double, ymin double, xmax double, ymax double").withColumn("geom", box_geom())
    pixel = settings.get("forest_pixel", 30.0)
    cells = spark.range(int(2000 / pixel)).select(F.col("id").alias("cx")).crossJoin(spark.range(int(2000 / pixel)).select(F.col("id").alias("cy")))
    forest = cells.withColumn("forest", F.when(F.col("cx") * pixel < 1000, 1.0).otherwise(0.0))
    s = Settings(block_width=500.0, block_height=500.0, small_tile_std=50.0, **settings)
    return dataset.select_tiles(spark.createDataFrame(tiles, TILE), area.select("geom", *BOX), forest, water, s)


def lake(spark, wkt, box):
    return spark.createDataFrame([(wkt, *box)], "wkt string, xmin double, ymin double, xmax double, ymax double").withColumn("geom", from_wkt("wkt")).drop("wkt")


def test_year_is_taken_inside_the_area_and_forest_by_its_own_pixel(spark):
    tiles = [(1, "P_2019", 0.0, 0.0, 300.0, 300.0), (2, "P_2023", 1500.0, 1500.0, 1800.0, 1800.0), (3, "P_2018", 300.0, 0.0, 610.0, 300.0)]
    plan = plan_of(spark, tiles, lake(spark, "POLYGON((900 900,910 900,910 910,900 900))", (900.0, 900.0, 910.0, 910.0)))
    assert {r.tile_id for r in plan.tiles.collect()} == {1, 3}


def test_water_counts_by_its_polygon(spark):
    water = lake(spark, "POLYGON((0 0,1000 0,0 1000,0 0))", (0.0, 0.0, 1000.0, 1000.0))
    plan = plan_of(spark, [(1, "P_2019", 0.0, 0.0, 1000.0, 1000.0), (2, "P_2019", 500.0, 500.0, 1000.0, 1000.0)], water)
    assert 4_900 <= plan.dry_cells.where("tile_id = 1").count() <= 5_100


def test_heights_belong_to_the_tile_of_the_draw(spark, monkeypatch):
    grid = spark.createDataFrame([(t, x, y, 10.0 * t) for t in (1, 2) for x in range(20) for y in range(20)], "tile_id long, cx long, cy long, height double")
    monkeypatch.setattr(dataset, "height_above_ground", lambda p: p)
    monkeypatch.setattr(dataset, "in_range", lambda p, *a: p)
    monkeypatch.setattr(dataset, "height_grid", lambda p, *a: grid.withColumn("n", F.lit(1)))
    tiles = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (2, 1, 0)], "tile_id long, bcol long, brow long")
    s = Settings(exclude_water=False, block_width=100.0, block_height=200.0)
    boxes = [(0, 0, 0.0, 0.0, 100.0, 200.0), (1, 0, 100.0, 0.0, 200.0, 200.0)]
    blocks = spark.createDataFrame(boxes, "bcol long, brow long, xmin double, ymin double, xmax double, ymax double")
    plan = dataset.TilePlan(tiles, blocks, None, spark.createDataFrame([(40.0,)], "points_per_tile double"))
    rows = dataset.sample_heights(tiles, plan, s, ground_known=True).collect()
    assert rows and len({r.id for r in rows}) == len(rows) and all(r.height == 10.0 * r.tile_id for r in rows)
    # a tile has draws in its chosen blocks only, and as many in each of them
    places = lambda t: [int(r.x // 100) for r in rows if r.tile_id == t]
    assert set(places(1)) == {0} and places(2).count(0) == places(2).count(1) > 0


def test_invalid_numbers_raise(spark):
    rows = spark.createDataFrame([(1, 2.0, [1.0, float("nan")]), (1, 3.0, [1.0, 2.0])], "folds int, height double, embedding array<double>")
    with pytest.raises(Exception, match="finite"):
        cross_products(rows)
    assert np.isfinite(cross_products(rows.where("height = 3"))[1]).all()
