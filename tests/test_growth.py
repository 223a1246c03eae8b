"""What grows with the tables and what must not: files, passes, copies."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from heightgrid.modeling import estimators as est
from heightgrid.operators import cover, ground, spatial_join
from heightgrid.session import checkpoint
from heightgrid.sources.outputs import written_keys
from heightgrid.sources.rasters import read_cells, write_cells


def test_files_do_not_follow_the_tiles(spark, tmp_path):
    path = str(tmp_path / "cells")
    cells = spark.range(900).select((F.col("id") % 300).alias("tile_id"), "id", F.lit(1).alias("cx"), (F.col("id") * 700).alias("cy"))
    write_cells(cells, path)
    back = read_cells(spark, path)
    assert back.select(F.col("_metadata.file_path")).distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, back.select("tile_id", "id", "cy").collect())) == sorted((i % 300, i, i * 700) for i in range(900))
    assert dict(written_keys(spark, path, "tile_id").dtypes) == {"tile_id": "bigint"}
    write_cells(cells.where("id < 0"), str(tmp_path / "none"))
    assert written_keys(spark, str(tmp_path / "none"), "tile_id").count() == 0


def test_written_keys_of_folders(spark, tmp_path):
    spark.range(4).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(str(tmp_path / "folders"))
    assert sorted(r["k"] for r in written_keys(spark, str(tmp_path / "folders"), "k").collect()) == [0, 1]


def test_far_blocks_go_before_the_bound_is_taken(spark):
    rng = random.Random(3)
    places = sorted({(k, float(rng.randrange(100)), float(rng.randrange(100))) for k in (1, 2) for _ in range(300)})
    grounds = [(k, x, y, float(rng.randrange(9))) for k, x, y in places if rng.random() < (0.3 if k == 1 else 0.02)]
    p = spark.createDataFrame(places, "tile_id long, x double, y double")
    g = spark.createDataFrame(grounds, "tile_id long, x double, y double, z double")
    near = ground.nearest_ground(p, g)
    got = {(r.tile_id, r.x, r.y): (r.d2, r.gz) for r in near.collect()}
    assert got == {(k, x, y): min(((x - a) ** 2 + (y - b) ** 2, z) for q, a, b, z in grounds if q == k) for k, x, y in places}
    odd = p.unionByName(spark.createDataFrame([(1, None, 3.0), (None, 5.0, 5.0), (2, 4.0, None)], p.schema))
    assert {(r.tile_id, r.x, r.y): (r.d2, r.gz) for r in ground.nearest_ground(odd, g).collect()} == got
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(d2" in plan.partition("Window")[2]


def test_ground_surface_needs_no_margin():
    rng = np.random.default_rng(4)
    tight, wide = np.full((31, 12), np.inf), np.full((91, 72), np.inf)
    i, j = rng.integers(0, 31, 150), rng.integers(0, 12, 150)
    tight[i, j] = wide[i + 30, j + 30] = 50 + rng.random(150) * 15
    there = np.isfinite(tight)
    for a, b in zip(ground._ground_surface(tight, 18, 1.0, 0.15, 0.5, 1.25), ground._ground_surface(wide, 18, 1.0, 0.15, 0.5, 1.25), strict=True):
        assert np.array_equal(a[there], b[30:-30, 30:-30][there])


def test_elastic_net_reads_the_rows_a_few_times(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 6)) + 0.5 * rng.normal(size=(200, 1))
    y = x @ rng.normal(size=6) + rng.normal(size=200)
    table = spark.createDataFrame([(v.tolist(), float(t), 1) for v, t in zip(x, y)], "embedding array<double>, height double, folds int")
    data = est.feature_table(table).select("features", "height").cache()
    data.count()
    spark.sparkContext.setJobGroup("elastic-net", "fit")
    model = est.ElasticNet(alpha=0.01, l1_ratio=0.5).fit(data)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("elastic-net"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 8
    b, xc, yc = np.zeros(6), x - x.mean(0), y - y.mean()
    for _ in range(500):
        for k in range(6):
            rho = xc[:, k] @ (yc - xc @ b + xc[:, k] * b[k]) / 200
            b[k] = np.sign(rho) * max(abs(rho) - 0.005, 0) / (xc[:, k] @ xc[:, k] / 200 + 0.005)
    assert model.coefficients.toArray() == pytest.approx(b, abs=1e-6)


def test_cells_of_polygons_follow_the_raster_and_meet_tiles_once(spark):
    rows = []
    rng = random.Random(5)
    for i in range(40):
        px, py, half = rng.randrange(600) + 0.3, float(rng.randrange(600)), rng.choice([20.0, 35.0, 80.0])
        ring = [(px - half, py), (px, py - half), (px + half, py), (px, py + half), (px - half, py)]
        rows.append((i, px, py, half, *(min(v[a] for v in ring) for a in (0, 1)), *(max(v[a] for v in ring) for a in (0, 1))))
    from heightgrid.functions.geometry import polygon_from_xy

    df = spark.createDataFrame(rows, "id long, px double, py double, half double, xmin double, ymin double, xmax double, ymax double")
    x, y, h = F.col("px"), F.col("py"), F.col("half")
    water = df.withColumn("geom", polygon_from_xy([(x - h, y), (x, y - h), (x + h, y), (x, y + h)]))
    coarse = cover.polygon_cells(water, "geom", [], most=cover.FEW, least=80.0)
    assert 2 * coarse.count() < cover.polygon_cells(water, "geom", []).count()
    tiles = spark.createDataFrame([(10 * i + j, 100.0 * i, 100.0 * j, 100.0 * i + 100, 100.0 * j + 100) for i in range(6) for j in range(6)], "tile_id long, xmin double, ymin double, xmax double, ymax double")
    keyed = spatial_join._keyed(coarse.withColumns(cover.cell_box()), cover.BOX, cover.extent_level(*cover.BOX), tiles.agg(F.collect_set(cover.extent_level(*cover.BOX)).alias("_levels")), "l", True)
    assert keyed.where("_llvl <= 7").count() == coarse.where("lvl <= 7").count()
    dry = {tuple(r) for r in spatial_join.cells_minus_polygons(tiles, water, "tile_id", "geom", 10.0).collect()}
    wet = lambda cx, cy: any(abs(cx * 10 + 5 - r[1]) + abs(cy * 10 + 5 - r[2]) <= r[3] for r in rows)
    assert dry == {(10 * (cx // 10) + cy // 10, cx, cy) for cx in range(60) for cy in range(60) if not wet(cx, cy)}


def _written(spark):
    from heightgrid.session import shared_dir

    return len(list(Path(shared_dir(spark)).glob("heightgrid-*/step-*")))


def test_predictions_out_of_fold_write_no_second_copy(spark):
    from heightgrid.modeling.search import cv_predictions, fits_at_once

    rows = [(i, [float(i % 7), float(i % 3)], float(i % 7) + 1, i % 3 + 1) for i in range(60)]
    table = spark.createDataFrame(rows, "id int, embedding array<float>, height double, folds int")
    before = _written(spark)
    assert cv_predictions(table, {"ElasticNet": {"alpha": 0.001, "l1_ratio": 0.5}}).count() == 60
    assert _written(spark) == before
    assert [fits_at_once(n, 4) for n in (0, 1_000, 1_500_000, 10**9)] == [4, 4, 2, 1]


def test_shuffles_behind_a_written_table_go(spark):
    blocks = spark._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: {b for b in blocks.getAllBlocks().mkString(",").split(",") if "shuffle" in b}
    before = shuffles()
    many = spark.range(20_000, numPartitions=4).groupBy((F.col("id") % 5_000).alias("k")).agg(F.sum("id").alias("s"))
    kept = checkpoint(many, drop_shuffles=True)
    assert shuffles() <= before
    assert kept.count() == 5_000 and kept.agg(F.sum("s")).first()[0] == 199_990_000
    assert checkpoint(many).count() == 5_000 and not shuffles() <= before
