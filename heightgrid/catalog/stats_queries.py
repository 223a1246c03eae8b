"""Aggregations, statistics tables, ranking, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from heightgrid.catalog.registry import query
from heightgrid.operators import grid, stats, zones
from heightgrid.operators.mosaic import mosaic
from heightgrid.operators.sampling import group_size_limit, ordered_ids


@query(
    "d3_zonal_mean_height",
    """SELECT t.tile_id, round(avg(c.height), 6) AS mean FROM tiles t
       JOIN chm c ON c.cx * 10 + 5 >= t.xmin AND c.cx * 10 + 5 < t.xmax AND c.cy * 10 + 5 >= t.ymin AND c.cy * 10 + 5 < t.ymax
       GROUP BY t.tile_id""",
)
def d3(t):
    from heightgrid.operators.spatial_join import zonal_mean

    out = zonal_mean(t.tiles, t.chm, "height", 10.0, ["tile_id"])
    return out.withColumn("mean", F.round("mean", 6))


_SITES_LEFT = """
WITH dil AS (SELECT DISTINCT s.cx + a.d AS cx, s.cy + b.d AS cy
             FROM (SELECT cx, cy FROM strata_px WHERE strata >= 5) s,
                  (VALUES (-1), (0), (1)) a(d), (VALUES (-1), (0), (1)) b(d))
"""


@query(
    "d4_union_closed",
    _SITES_LEFT
    + """SELECT cx, cy FROM (SELECT cx + a.d AS cx, cy + b.d AS cy, count(*) AS k
         FROM dil, (VALUES (-1), (0), (1)) a(d), (VALUES (-1), (0), (1)) b(d) GROUP BY 1, 2) WHERE k = 9""",
)
def d4(t):
    """Union outline of all cells of tall strata, small gaps closed."""
    return grid.close_gaps(t.strata_px.where("strata >= 5"), 2.0, 10.0)


@query(
    "d5_dissolve",
    """SELECT tile_id, strata, count(*) AS n_cells, CAST(count(*) * 100 AS DOUBLE) AS area,
              CAST(min(cx) * 10 AS DOUBLE) AS xmin, CAST(min(cy) * 10 AS DOUBLE) AS ymin,
              CAST((max(cx) + 1) * 10 AS DOUBLE) AS xmax, CAST((max(cy) + 1) * 10 AS DOUBLE) AS ymax
       FROM strata_px GROUP BY tile_id, strata""",
)
def d5(t):
    return zones.dissolve(t.strata_px, ["tile_id", "strata"], 10.0)


@query("d6_total_bounds", "SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM water")
def d6(t):
    return t.water.agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


_DESCRIBE = """SELECT count({v}) AS count, round(avg({v}), 6) AS mean, round(stddev_samp({v}), 6) AS std, round(min({v}), 6) AS min,
 round(quantile_cont({v}, 0.25), 6) AS p25, round(quantile_cont({v}, 0.5), 6) AS p50, round(quantile_cont({v}, 0.75), 6) AS p75,
 round(max({v}), 6) AS max FROM {t}"""


@query("d7_describe", _DESCRIBE.format(v="height", t="samples"))
def d7(t):
    return stats.describe(t.samples, "height")


@query(
    "d8_remove_outliers",
    """SELECT s.id, s.tile_id, s.strata, s.x, s.y, s.height FROM samples s
       CROSS JOIN (SELECT avg(height) AS m, stddev_samp(height) AS d FROM samples) k
       WHERE abs((s.height - k.m) / k.d) < 2.5""",
)
def d8(t):
    return stats.remove_outliers(t.samples)


@query(
    "d9_smallest_group",
    "SELECT least(min(c), 20) AS n FROM (SELECT count(*) AS c FROM samples GROUP BY tile_id, strata)",
)
def d9(t):
    return group_size_limit(t.samples, ["tile_id", "strata"], 20)


@query("d10_max_year", "SELECT max(CAST(right(project, 4) AS INTEGER)) AS year FROM tiles")
def d10(t):
    from heightgrid.functions.text import project_year

    return t.tiles.agg(F.max(project_year("project")).alias("year"))


@query("d11_distinct_folds", "SELECT DISTINCT folds FROM cv_preds")
def d11(t):
    return t.cv_preds.select("folds").distinct()


_SCORES = """SELECT {k} round(1 - sum((y_true - y_pred) * (y_true - y_pred)) / sum((y_true - m) * (y_true - m)), 6) AS R2,
 round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 6) AS RMSE, round(avg(abs(y_true - y_pred)), 6) AS MAE"""


@query(
    "d12_cv_scores",
    _SCORES.format(k="model, folds,")
    + " FROM (SELECT *, avg(y_true) OVER (PARTITION BY model, folds) AS m FROM cv_preds) GROUP BY model, folds",
)
def d12(t):
    s = stats.regression_scores(t.cv_preds, ["model", "folds"])
    return s.select("model", "folds", *[F.round(c, 6).alias(c) for c in ("R2", "RMSE", "MAE")])


@query(
    "d13_model_summary",
    "SELECT model, round(avg(rmse), 6) AS mean, round(stddev_samp(rmse), 6) AS std FROM cv_results GROUP BY model",
)
def d13(t):
    s = stats.model_summary(t.cv_results, "rmse")
    return s.select("model", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(
    "d14_band_correlation",
    """WITH s AS (SELECT c.height, e.embedding FROM chm c JOIN emb_px e USING (tile_id, cx, cy)),
            l AS (SELECT height, unnest(range(0, 64)) AS dim, unnest(embedding) AS v FROM s)
       SELECT CAST(dim AS INTEGER) AS dim, concat('A', lpad(CAST(dim AS VARCHAR), 2, '0')) AS band,
              round(corr(CAST(v AS DOUBLE), height), 4) AS corr FROM l GROUP BY dim""",
)
def d14(t):
    s = t.chm.join(t.emb_px, ["tile_id", "cx", "cy"]).select("height", "embedding")
    return stats.band_correlations(s, "height", digits=4)


@query(
    "d15_histogram",
    """SELECT CAST(least(floor((height - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
       FROM samples CROSS JOIN (SELECT min(height) AS lo, max(height) AS hi FROM samples) GROUP BY 1""",
)
def d15(t):
    return stats.histogram(t.samples, "height", 50).select("bin", "n")


@query(
    "d16_kernel_density",
    """WITH s AS (SELECT count(height) AS n, stddev_samp(height) * pow(count(height), -0.2) AS h, min(height) AS lo, max(height) AS hi
                  FROM samples),
            b AS (SELECT lo + (bin + 0.5) * (hi - lo) / 400 AS m, c FROM (
                    SELECT least(floor((height - lo) / ((hi - lo) / 400)), 399) AS bin, lo, hi, count(*) AS c
                    FROM samples CROSS JOIN s GROUP BY 1, 2, 3)),
            g AS (SELECT CAST(unnest(range(0, 100)) AS INTEGER) AS i)
       SELECT i, round(s.lo + (s.hi - s.lo) * i / 99, 6) AS x,
              round(sum(b.c * exp(-pow((s.lo + (s.hi - s.lo) * i / 99 - b.m) / s.h, 2) / 2)) / (s.n * s.h * sqrt(2 * pi())), 8) AS density
       FROM g CROSS JOIN s CROSS JOIN b GROUP BY i, s.lo, s.hi, s.n, s.h""",
)
def d16(t):
    k = stats.kernel_density(t.samples, "height", 100, 400)
    return k.select("i", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query(
    "d17_box_plot",
    """WITH q AS (SELECT l_returnflag AS model, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                         quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
       SELECT q.model, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
              min(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
              max(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
              count(*) FILTER (l_extendedprice NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
       FROM lineitem l JOIN q ON q.model = l.l_returnflag GROUP BY q.model, q1, median, q3""",
)
def d17(t):
    df = t.lineitem.select(F.col("l_returnflag").alias("model"), "l_extendedprice")
    b = stats.box_plot(df, ["model"], "l_extendedprice")
    return b.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query(
    "d17_box_outliers",
    """WITH c AS (SELECT user_id % 3 AS g, value FROM events),
            q AS (SELECT g, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM c GROUP BY g)
       SELECT c.g, c.value AS outlier FROM c JOIN q USING (g)
       WHERE c.value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
)
def d17_outliers(t):
    return stats.box_outliers(t.events.select((F.col("user_id") % 3).alias("g"), "value"), ["g"], "value")


@query(
    "d18_fit_line",
    _SCORES.format(k="model,").replace(", round(avg(abs(y_true - y_pred)), 6) AS MAE", "")
    + """, round(regr_slope(y_pred, y_true), 6) AS slope, round(regr_intercept(y_pred, y_true), 6) AS intercept
        FROM (SELECT *, avg(y_true) OVER (PARTITION BY model) AS m FROM cv_preds) GROUP BY model""",
)
def d18(t):
    f = stats.fit_line(t.cv_preds, ["model"])
    return f.select("model", *[F.round(c, 6).alias(c) for c in ("R2", "RMSE", "slope", "intercept")])


@query(
    "l11_fit_tables",
    """SELECT model, metric, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3 FROM (
         SELECT model, 'rmse' AS metric, quantile_cont(rmse, 0.25) AS q1, quantile_cont(rmse, 0.5) AS median, quantile_cont(rmse, 0.75) AS q3
         FROM cv_results GROUP BY model
         UNION ALL SELECT model, 'mae', quantile_cont(mae, 0.25), quantile_cont(mae, 0.5), quantile_cont(mae, 0.75) FROM cv_results GROUP BY model
         UNION ALL SELECT model, 'r2', quantile_cont(r2, 0.25), quantile_cont(r2, 0.5), quantile_cont(r2, 0.75) FROM cv_results GROUP BY model)""",
)
def l11(t):
    """Box-plot rows of every metric and model in one table."""
    long = t.cv_results.unpivot(["model"], ["r2", "rmse", "mae"], "metric", "value")
    b = stats.box_plot(long, ["model", "metric"], "value")
    return b.select("model", "metric", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")])


@query(
    "d19_mosaic",
    """SELECT cx, cy, value FROM (SELECT *, row_number() OVER (PARTITION BY cx, cy ORDER BY image_date DESC, image_id DESC) AS rn
       FROM images WHERE value IS NOT NULL) WHERE rn = 1""",
)
def d19(t):
    return mosaic(t.images, ["value"])


@query(
    "d20_pyramid",
    """WITH l AS (SELECT unnest([1, 2, 3]) AS level)
       SELECT CAST(level AS INTEGER) AS level, CAST(floor(cx / pow(2, level)) AS BIGINT) AS cx, CAST(floor(cy / pow(2, level)) AS BIGINT) AS cy,
              round(avg(height), 9) AS height FROM chm, l GROUP BY 1, 2, 3""",
)
def d20(t):
    return grid.pyramid(t.chm, "height", 3).withColumn("height", F.round("height", 9))


_ZONES = """
WITH RECURSIVE cell AS (SELECT tile_id, cx, cy, strata, cx * 4294967296 + cy AS code FROM strata_px),
 reach AS (
   SELECT tile_id, cx, cy, strata, code AS zone_id FROM cell
   UNION
   SELECT n.tile_id, n.cx, n.cy, n.strata, r.zone_id FROM reach r JOIN cell n
     ON n.tile_id = r.tile_id AND n.strata = r.strata AND abs(n.cx - r.cx) + abs(n.cy - r.cy) = 1 AND r.zone_id < n.code),
 zoned AS (SELECT tile_id, cx, cy, strata, min(zone_id) AS zone_id FROM reach GROUP BY ALL)
"""


@query("d21_zone_labels", _ZONES + "SELECT tile_id, cx, cy, strata, zone_id FROM zoned")
def d21(t):
    return zones.label_zones(t.strata_px.select("tile_id", "cx", "cy", "strata"))


@query(
    "d21_zone_table",
    _ZONES
    + """SELECT tile_id, strata, zone_id, count(*) AS n_cells, CAST(count(*) * 100 AS DOUBLE) AS area,
                CASE WHEN strata = 11 THEN '>50' ELSE concat(strata * 5 - 5, '-', strata * 5) END AS label
         FROM zoned GROUP BY tile_id, strata, zone_id""",
)
def d21_table(t):
    from heightgrid.settings import HEIGHT_LABELS

    z = zones.label_zones(t.strata_px.select("tile_id", "cx", "cy", "strata"))
    return zones.zone_table(z, 10.0, labels=HEIGHT_LABELS)


@query(
    "b10_large_zones",
    _ZONES
    + """SELECT tile_id, cx, cy, strata, zone_id FROM zoned
         WHERE (tile_id, zone_id) IN (SELECT (tile_id, zone_id) FROM zoned GROUP BY tile_id, zone_id HAVING count(*) * 100 > 1000)""",
)
def b10(t):
    z = zones.label_zones(t.strata_px.select("tile_id", "cx", "cy", "strata"))
    return zones.large_zones(z, 1000.0, 10.0)


@query(
    "d22_removed_rows",
    """WITH n AS (SELECT (SELECT count(*) FROM points) AS a, (SELECT count(*) FROM points WHERE hag BETWEEN 0 AND 50) AS b,
                         (SELECT count(*) FROM points WHERE hag BETWEEN 0 AND 50 AND classification = 5) AS c)
       SELECT 0 AS step, 'read' AS stage, a AS rows, CAST(0 AS BIGINT) AS removed FROM n
       UNION ALL SELECT 1, 'range', b, a - b FROM n UNION ALL SELECT 2, 'class', c, b - c FROM n""",
)
def d22(t):
    p = t.points
    r = p.where("hag BETWEEN 0 AND 50")
    return stats.removed_rows({"read": p, "range": r, "class": r.where("classification = 5")})


@query("e1_sequential_ids", "SELECT tile_id, tile_name, row_number() OVER (ORDER BY tile_id) - 1 AS id FROM tiles")
def e1(t):
    return ordered_ids(t.tiles.select("tile_id", "tile_name"), "tile_id")


@query("e1_sequential_order_ids", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS id FROM orders")
def e1_orders(t):
    return ordered_ids(t.orders.select("o_orderkey"), "o_orderkey")


@query(
    "e2_fold_numbers",
    "SELECT folds, CAST(dense_rank() OVER (ORDER BY folds) AS INTEGER) AS fold_no FROM (SELECT DISTINCT folds * 10 AS folds FROM cv_preds)",
)
def e2(t):
    return stats.number_folds(t.cv_preds.select((F.col("folds") * 10).alias("folds")))


@query(
    "e3_rows_per_group",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
         SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY md5(concat_ws('|', '420', l_orderkey, l_linenumber, l_partkey, l_suppkey)),
           l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn <= 25""",
)
def e3(t):
    from heightgrid.operators.sampling import sample_per_group

    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return sample_per_group(t.lineitem.select("l_returnflag", *ids), ["l_returnflag"], 25, 420, ids)


@query("f1_sorted_grid", "SELECT tile_id, cx, cy, height FROM chm ORDER BY tile_id, cy, cx")
def f1(t):
    return t.chm.select("tile_id", "cx", "cy", "height").orderBy("tile_id", "cy", "cx")


@query(
    "f2_best_model",
    """SELECT model, round(mean, 6) AS mean, round(std, 6) AS std FROM (
         SELECT model, avg(rmse) AS mean, stddev_samp(rmse) AS std FROM cv_results GROUP BY model) ORDER BY mean, model LIMIT 1""",
)
def f2(t):
    b = stats.best_model(t.cv_results, "rmse")
    return b.select("model", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(
    "f2_best_model_r2",
    """SELECT model, round(mean, 6) AS mean, round(std, 6) AS std FROM (
         SELECT model, avg(r2) AS mean, stddev_samp(r2) AS std FROM cv_results GROUP BY model) ORDER BY mean DESC, model LIMIT 1""",
)
def f2_r2(t):
    b = stats.best_model(t.cv_results, "r2")
    return b.select("model", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("f3_first_row", "SELECT tile_id, tile_name, url FROM tiles ORDER BY tile_id LIMIT 1")
def f3(t):
    return t.tiles.select("tile_id", "tile_name", "url").orderBy("tile_id").limit(1)


@query(
    "g1_concat_results",
    """SELECT model, folds, rmse_r, 'first' AS part FROM (SELECT model, folds, round(rmse, 6) AS rmse_r FROM cv_results WHERE folds <= 3)
       UNION ALL SELECT model, folds, round(rmse, 6), 'second' FROM cv_results WHERE folds > 2""",
)
def g1(t):
    r = t.cv_results.select("model", "folds", F.round("rmse", 6).alias("rmse_r"))
    return r.where("folds <= 3").withColumn("part", F.lit("first")).unionByName(r.where("folds > 2").withColumn("part", F.lit("second")))


@query(
    "g3_cell_sets",
    """WITH a AS (SELECT DISTINCT cx, cy FROM strata_px WHERE strata BETWEEN 3 AND 8),
            b AS (SELECT DISTINCT cx, cy FROM forest_px WHERE forest = 1)
       SELECT 'union' AS op, cx, cy FROM (SELECT * FROM a UNION SELECT * FROM b)
       UNION ALL SELECT 'intersection', cx, cy FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
       UNION ALL SELECT 'difference', cx, cy FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""",
)
def g3(t):
    a = t.strata_px.where("strata BETWEEN 3 AND 8").select("cx", "cy")
    b = t.forest_px.where("forest = 1").select("cx", "cy")
    tag = lambda name, df: df.select(F.lit(name).alias("op"), "cx", "cy")
    return (
        tag("union", a.union(b).distinct())
        .unionByName(tag("intersection", a.intersect(b)))
        .unionByName(tag("difference", a.distinct().join(b, ["cx", "cy"], "left_anti")))
    )
