import numpy as np
import pytest
from pyspark.sql import functions as F

from heightgrid.functions.geometry import box_geom
from heightgrid.operators import grid, sampling, stats, zones
from heightgrid.operators.spatial_join import bucket_pairs, points_in_boxes, spatial_join


def test_known_tile_site_pairs(spark):
    """39 pairs between 25 tiles of 200 m and five diamonds."""
    import heightgrid.functions.geometry as geo

    tiles = spark.range(25).selectExpr(
        "id AS tile", "CAST(500000 + (id % 5) * 200 AS DOUBLE) AS xmin", "CAST(6500000 + floor(id / 5) * 200 AS DOUBLE) AS ymin",
        "CAST(500200 + (id % 5) * 200 AS DOUBLE) AS xmax", "CAST(6500200 + floor(id / 5) * 200 AS DOUBLE) AS ymax",
    ).withColumn("tg", box_geom())
    px, py, h = F.col("px"), F.lit(6500500.0), F.lit(250.0)
    sites = spark.range(5).selectExpr("id AS site", "CAST(500100 + 200 * id AS DOUBLE) AS px")
    sites = sites.withColumn("sg", geo.polygon_from_xy([(px - h, py), (px, py - h), (px + h, py), (px, py + h)]))
    sites = sites.withColumns({c: geo.bbox("sg")[c] for c in ("xmin", "ymin", "xmax", "ymax")})
    pairs = spatial_join(tiles, sites, "tg", "sg").groupBy("site").count().orderBy("site").collect()
    assert [r["count"] for r in pairs] == [6, 9, 9, 9, 6]


def test_bucket_pairs_match_brute_force_with_mixed_sizes(spark):
    rng = np.random.default_rng(3)

    def boxes(n, sizes):
        lo = rng.uniform(-50, 50, (n, 2)).round(1)
        return [(i, *map(float, p), float(p[0] + s), float(p[1] + t)) for i, (p, s, t) in enumerate(zip(lo, rng.choice(sizes, n), rng.choice(sizes, n)))]

    a, b = boxes(80, [0.0, 0.5, 8.0]), boxes(60, [0.1, 3.0, 70.0])
    schema = "{} int, xmin double, ymin double, xmax double, ymax double"
    out = bucket_pairs(spark.createDataFrame(a, schema.format("i")), spark.createDataFrame(b, schema.format("j")))
    got = sorted((r["i"], r["j"]) for r in out.collect())
    want = sorted((p[0], q[0]) for p in a for q in b if p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2])
    assert got == want


def test_point_on_shared_border_goes_to_one_box(spark):
    pts = spark.createDataFrame([(10.0, 5.0)], "x double, y double")
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0)], "k int, xmin double, ymin double, xmax double, ymax double")
    assert [r["k"] for r in points_in_boxes(pts, boxes).collect()] == [2]


def test_zones_across_windows(spark):
    """A snake that crosses many window borders is one zone; a diagonal neighbour is another."""
    snake = [(x, y) for y in range(0, 200, 4) for x in range(150)] + [(149 if (y // 4) % 2 == 0 else 0, y + d) for y in range(0, 196, 4) for d in (1, 2, 3)]
    rows = [(1, x, y, 3) for x, y in set(snake)] + [(1, 151, 199, 3), (2, 0, 0, 3)]
    df = spark.createDataFrame(rows, "tile_id long, cx long, cy long, strata int")
    table = zones.zone_table(zones.label_zones(df), 10.0).orderBy(F.desc("n_cells")).collect()
    assert [r["n_cells"] for r in table] == [len(set(snake)), 1, 1]


def test_zones_on_one_stratum_checkerboard_and_hot_tile(spark):
    rows = [(1, x, y, 1 + (x + y) % 2) for x in range(20) for y in range(20)]
    df = spark.createDataFrame(rows, "tile_id long, cx long, cy long, strata int")
    assert zones.label_zones(df).select("zone_id").distinct().count() == 400


def test_edges_of_strata(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (5.0,), (5.1,), (50.0,), (50.1,)], "h double")
    got = [r["s"] for r in df.select(grid.digitize("h", range(0, 51, 5)).alias("s")).collect()]
    assert got == [0, 1, 1, 2, 10, 11]


def test_stratum_labels_and_offset(spark):
    from heightgrid.settings import HEIGHT_LABELS

    r = spark.range(1).select(
        grid.stratum_label(F.lit(1), HEIGHT_LABELS).alias("a"), grid.stratum_label(F.lit(1), HEIGHT_LABELS, 1).alias("b"),
        grid.stratum_label(F.lit(11), HEIGHT_LABELS, 1).alias("c"),
    ).first()
    assert tuple(r) == ("0-5", "5-10", None)


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    v = np.concatenate([rng.normal(size=n), np.full(n, 0.25)])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    q = stats.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.95, 1.0]).first()["q"]
    assert q == pytest.approx(np.quantile(v, [0, 0.25, 0.5, 0.95, 1.0]), abs=1e-12)


def test_quantiles_of_one_hot_group(spark):
    df = spark.range(200_000).select((F.col("id") % 3 == 0).alias("g"), F.hash("id").cast("double").alias("v"))
    got = {r["g"]: r["q"][0] for r in stats.exact_quantiles(df, "v", [0.95], ["g"]).collect()}
    want = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.expr("percentile(v, 0.95)").alias("q")).collect()}
    assert got == pytest.approx(want)


def test_quantiles_by_rounds(spark, monkeypatch):
    """Many rounds, heavy ties, far outliers and sketches that are wrong all end at the same values."""
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(size=3000), np.full(2000, 0.5), rng.integers(0, 2, 2000), [1e300, -1e300, 1e-300]])
    g = rng.integers(0, 3, len(v))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v, strict=True)] + [(1, None), (7, None)], "g int, v double")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    monkeypatch.setattr(stats, "_FEW", 300)
    for parts, sketch in ((1_000, 10_000), (50, 20)):
        monkeypatch.setattr(stats, "_PARTS", parts)
        monkeypatch.setattr(stats, "_SKETCH", sketch)
        assert stats.exact_quantiles(df, "v", probs).first()["q"] == pytest.approx(np.quantile(v, probs), rel=1e-12)
        got = {r["g"]: r["q"] for r in stats.exact_quantiles(df, "v", probs, ["g"]).collect()}
        assert set(got) == {0, 1, 2}
        for k, q in got.items():
            assert q == pytest.approx(np.quantile(v[g == k], probs), rel=1e-12)
    assert stats.exact_quantiles(df.where("v is null"), "v", probs).isEmpty()


def test_outliers_without_spread(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "height double")
    assert stats.remove_outliers(df).count() == 0


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("g"))
    pick = lambda d: sorted(r["id"] for r in sampling.stratified_sample(d, ["g"], 420, ["id"], 20).collect())
    assert pick(df.repartition(1)) == pick(df.repartition(200))
    assert len(pick(df)) == 140
    again = lambda d: sorted((r["g"], r["draw"], r["id"]) for r in sampling.resample_groups(d, ["g"], 50, 1, ["id"]).collect())
    assert again(df.repartition(1)) == again(df.repartition(50))
    assert len(again(df)) == 350


def test_random_points_fall_in_their_cells(spark):
    cells = spark.createDataFrame([(1, 2, x, 0) for x in range(0, 40, 4)], "tile_id long, strata int, cx long, cy long")
    counts = spark.createDataFrame([(1, 2, 500)], "tile_id long, strata int, n int")
    pts = sampling.random_points(cells, ["tile_id", "strata"], counts, "n", 10.0, 420)
    assert pts.count() == 500
    assert pts.where("floor(x / 10) <> cx OR floor(y / 10) <> cy").count() == 0
    assert pts.groupBy("cx").count().agg(F.min("count")).first()[0] > 20


def test_folds_cover_all_blocks_evenly(spark):
    layer = spark.range(400).selectExpr("CAST(id % 20 * 10 AS DOUBLE) AS xmin", "CAST(floor(id / 20) * 10 AS DOUBLE) AS ymin").selectExpr("*", "xmin + 9 AS xmax", "ymin + 9 AS ymax")
    blocks = sampling.spatial_blocks(layer, 40.0, 40.0, 5)
    sizes = [r["count"] for r in blocks.groupBy("folds").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_closing_fills_a_gap_and_keeps_the_outline(spark):
    cells = [(x, y) for x in range(10) for y in range(10) if x != 5]
    out = grid.close_gaps(spark.createDataFrame(cells, "cx long, cy long"), 2.0, 10.0)
    assert sorted((r["cx"], r["cy"]) for r in out.collect()) == [(x, y) for x in range(10) for y in range(10)]
