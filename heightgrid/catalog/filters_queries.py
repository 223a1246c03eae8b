"""Filters, projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from heightgrid.catalog.registry import query
from heightgrid.functions import geometry as geo
from heightgrid.functions import text as tx
from heightgrid.functions.rand import stable_id
from heightgrid.operators import grid, stats
from heightgrid.operators.filters import (
    clip_to_square,
    fold_split,
    latest_or_given_year,
    training_rows,
    valid_pixels,
)
from heightgrid.operators.scoring import clamp_predictions, linear_score
from heightgrid.operators.spatial_join import BOX, bucket_pairs, cells_minus_boxes
from heightgrid.settings import COVER_EDGES, COVER_LABELS, HEIGHT_EDGES, HEIGHT_LABELS
from heightgrid.sources.tables import select_water, site_rows


def diamond():
    px, py, h = F.col("px"), F.col("py"), F.col("half")
    return geo.polygon_from_xy([(px - h, py), (px, py - h), (px + h, py), (px, py + h)])


def site_geoms(t):
    g = t.sites.withColumn("geom", diamond())
    return g.withColumns({c: geo.bbox("geom")[c] for c in BOX})


@query("b1_site_selection", "SELECT site_id, px, py, half FROM sites WHERE site_name = 'BUILDING'")
def b1(t):
    return site_rows(t.sites, "site_name", "BUILDING").select("site_id", "px", "py", "half")


@query(
    "b2_tiles_in_envelope",
    "SELECT tile_id, tile_name FROM tiles WHERE xmin <= 500450 AND xmax >= 500200 AND ymin <= 6500300 AND ymax >= 6500000",
)
def b2(t):
    """Closed box test first (pushed down), exact polygon test after it."""
    c = F.col
    hit = t.tiles.where((c("xmin") <= 500450) & (c("xmax") >= 500200) & (c("ymin") <= 6500300) & (c("ymax") >= 6500000))
    env = geo.box_geom(F.lit(500200.0), F.lit(6500000.0), F.lit(500450.0), F.lit(6500300.0))
    return hit.where(geo.intersects(geo.box_geom(), env)).select("tile_id", "tile_name")


@query("b3_project_year", "SELECT tile_id, CAST(right(project, 4) AS INTEGER) AS year FROM tiles")
def b3(t):
    return t.tiles.select("tile_id", tx.project_year("project").alias("year"))


@query(
    "b4_year_choice",
    """WITH y AS (SELECT tile_id, CAST(right(project, 4) AS INTEGER) AS year FROM tiles)
       SELECT tile_id, year, 'given' AS mode FROM y WHERE year = 2017
       UNION ALL SELECT tile_id, year, 'absent' FROM y WHERE year = (SELECT max(year) FROM y)
       UNION ALL SELECT tile_id, year, 'latest' FROM y WHERE year = (SELECT max(year) FROM y)""",
)
def b4(t):
    tiles = t.tiles.select("tile_id", tx.project_year("project").alias("year"))
    tag = lambda df, m: df.withColumn("mode", F.lit(m))
    return (
        tag(latest_or_given_year(tiles, 2017), "given")
        .unionByName(tag(latest_or_given_year(tiles, 1999), "absent"))
        .unionByName(tag(latest_or_given_year(tiles, None), "latest"))
    )


@query(
    "b5_water_corner",
    """SELECT id, xmin, ymin FROM water WHERE xmin BETWEEN 500100 AND 500600 AND ymin BETWEEN 6500050 AND 6500400
       AND geom_type NOT IN ('LINESTRING', 'POINT')""",
)
def b5(t):
    return select_water(t.water, (500100, 6500050, 500600, 6500400), "corner").select("id", "xmin", "ymin")


@query(
    "b5_water_overlap",
    """SELECT id, xmin, ymin FROM water WHERE xmin <= 500600 AND xmax >= 500100 AND ymin <= 6500400 AND ymax >= 6500050
       AND geom_type NOT IN ('LINESTRING', 'POINT')""",
)
def b5_overlap(t):
    return select_water(t.water, (500100, 6500050, 500600, 6500400)).select("id", "xmin", "ymin")


@query("b6_drop_types", "SELECT geom_type, count(*) AS n FROM water WHERE geom_type NOT IN ('LINESTRING', 'POINT') GROUP BY geom_type")
def b6(t):
    g = t.water.withColumn("geom", F.struct(F.col("geom_type").alias("type"), geo.box_geom()["parts"].alias("parts")))
    kept = g.where(~geo.geom_type("geom").isin("LINESTRING", "POINT"))
    return kept.groupBy(geo.geom_type("geom").alias("geom_type")).agg(F.count(F.lit(1)).alias("n"))


@query("b7_drop_invalid", "SELECT site_id FROM sites WHERE site_id % 4 = 0")
def b7(t):
    """Every fourth ring is sound; the others are open, crossing (bow tie) or flat."""
    s = t.sites
    px, py, h = F.col("px"), F.col("py"), F.col("half")
    good = diamond()
    crossing = geo.polygon_from_xy([(px, py), (px + h, py + h), (px + h, py), (px, py + h)])
    flat = geo.polygon_from_xy([(px, py), (px + h, py), (px - h, py)])
    opened = geo.geometry("POLYGON", F.transform(good["parts"], lambda p: F.transform(p, lambda r: F.slice(r, 1, 4))))
    k = F.col("site_id") % 4
    g = s.withColumn("geom", F.when(k == 0, good).when(k == 1, crossing).when(k == 2, flat).otherwise(opened))
    return g.where(geo.is_valid("geom")).select("site_id")


@query("b8_cover_threshold", "SELECT tile_id, cover FROM tile_cover WHERE cover >= 0.25")
def b8(t):
    return t.tile_cover.where("cover >= 0.25D").select("tile_id", "cover")


_DRY = """
WITH dry AS (
  SELECT t.tile_id, x.cx, y.cy FROM tiles t,
    LATERAL (SELECT unnest(range(CAST(t.xmin / 10 AS BIGINT), CAST(t.xmax / 10 AS BIGINT))) AS cx) x,
    LATERAL (SELECT unnest(range(CAST(t.ymin / 10 AS BIGINT), CAST(t.ymax / 10 AS BIGINT))) AS cy) y
  WHERE NOT EXISTS (SELECT 1 FROM water w WHERE w.geom_type = 'POLYGON' AND x.cx * 10 + 5 >= w.xmin AND x.cx * 10 + 5 < w.xmax
                    AND y.cy * 10 + 5 >= w.ymin AND y.cy * 10 + 5 < w.ymax)),
 a AS (SELECT tile_id, CAST(count(*) * 100 AS DOUBLE) AS area FROM dry GROUP BY tile_id)
"""


@query(
    "b9_small_tiles",
    _DRY + "SELECT a.tile_id, a.area FROM a CROSS JOIN (SELECT avg(area) - 1.5 * stddev_samp(area) AS cut FROM a) k WHERE a.area > k.cut",
)
def b9(t):
    dry = cells_minus_boxes(t.tiles, t.water.where("geom_type = 'POLYGON'"), "tile_id", 10.0)
    area = dry.groupBy("tile_id").agg((F.count(F.lit(1)) * 100.0).alias("area"))
    return stats.drop_small(area, "area", 1.5)


@query("b11_open_height_filter", "SELECT id, height FROM samples WHERE height > 0 AND height < 50")
def b11(t):
    return t.samples.where((F.col("height") > 0) & (F.col("height") < 50)).select("id", "height")


@query(
    "b12_training_rows",
    """SELECT id, height, vec FROM (SELECT s.id, s.height, CASE WHEN s.strata <> 3 THEN s.strata * 2 END AS vec FROM samples s)
       WHERE height > 10 AND height <= 40 AND vec IS NOT NULL""",
)
def b12(t):
    s = t.samples.selectExpr("id", "height", "CASE WHEN strata <> 3 THEN strata * 2 END AS vec")
    return training_rows(s, 10.0, 40.0)


@query(
    "b16_forest_mask",
    """SELECT image_id, cx, cy, CASE WHEN b1 <> 127 OR b2 <> 127 OR b3 <> 127 THEN 1 ELSE 0 END AS forest FROM forest_images""",
)
def b16(t):
    from heightgrid.operators.mosaic import forest_mask

    return forest_mask(t.forest_images).select("image_id", "cx", "cy", "forest")


_HOLES = """
WITH px AS (SELECT tile_id, cx, cy, CASE WHEN cx % 7 = 0 AND cy % 3 = 0 THEN NULL ELSE embedding END AS embedding,
                   (cx + cy) % 13 = 0 AS broken FROM emb_px)
"""


@query("b17_valid_pixels", _HOLES + "SELECT tile_id, cx, cy, embedding IS NOT NULL AND NOT broken AS valid FROM px")
def b17(t):
    """Pixels with a missing vector, a NaN or an Inf in any band are marked invalid."""
    px = t.emb_px.select("tile_id", "cx", "cy", _with_holes().alias("embedding"))
    return valid_pixels(px, "embedding").select("tile_id", "cx", "cy", "valid")


def _with_holes():
    bad = F.when(F.col("cx") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf"))).cast("float")
    broken = F.transform("embedding", lambda v, i: F.when(i == 5, bad).otherwise(v))
    return F.when((F.col("cx") % 7 == 0) & (F.col("cy") % 3 == 0), F.lit(None)).when((F.col("cx") + F.col("cy")) % 13 == 0, broken).otherwise(F.col("embedding"))


_COEF = "list_transform(range(0, 64), lambda i: CAST((i * 7) % 11 - 5 AS DOUBLE) / 2)"


@query(
    "b18_clamp_predictions",
    _HOLES
    + f"""SELECT tile_id, cx, cy, CASE WHEN embedding IS NOT NULL AND NOT broken
            THEN round(greatest(list_dot_product(CAST(embedding AS DOUBLE[]), {_COEF}) + 1.5, 0), 6) END AS height FROM px""",
)
def b18(t):
    """Linear scores of valid pixels, negative ones at 0; masked pixels stay without a number (NaN, shown as null)."""
    px = valid_pixels(t.emb_px.select("tile_id", "cx", "cy", _with_holes().alias("embedding")), "embedding")
    scored = px.withColumn("pred", F.when(F.col("valid"), linear_score("embedding", [((i * 7) % 11 - 5) / 2 for i in range(64)], 1.5)))
    out = clamp_predictions(scored, "pred", "valid", "height")
    return out.select("tile_id", "cx", "cy", F.when(~F.isnan("height"), F.round("height", 6)).alias("height"))


@query(
    "b19_projection",
    """SELECT md5(concat(tile_id, '|', tile_name)) AS id, tile_name AS name, 'TILE' AS layer,
              split_part(list_extract(string_split(url, '/'), -1), '.', 1) AS stem FROM tiles""",
)
def b19(t):
    out = t.tiles.withColumns({"id": stable_id("tile_id", "tile_name"), "layer": F.lit("TILE"), "stem": tx.file_stem("url")})
    return out.drop("project", "url", *BOX).withColumnRenamed("tile_name", "name").select("id", "name", "layer", "stem")


@query(
    "b20_fold_split",
    """SELECT folds, 'train' AS part, round(sum(y_true), 4) AS s FROM cv_preds WHERE folds <> 2 GROUP BY folds
       UNION ALL SELECT folds, 'valid', round(sum(y_true), 4) FROM cv_preds WHERE folds = 2 GROUP BY folds""",
)
def b20(t):
    train, valid = fold_split(t.cv_preds, 2)
    agg = lambda df, name: df.groupBy("folds").agg(F.round(F.sum("y_true"), 4).alias("s")).select("folds", F.lit(name).alias("part"), "s")
    return agg(train, "train").unionByName(agg(valid, "valid"))


@query(
    "b21_clip_to_square",
    """SELECT site_id, round(CASE WHEN half <= 30 THEN 2 * half * half
                             WHEN half <= 60 THEN 2 * half * half - 2 * (half - 30) * (half - 30) * 2
                             ELSE 3600 END, 4) AS area FROM sites""",
)
def b21(t):
    """Each area clipped to a square of half-width 30 m round its centroid."""
    out = clip_to_square(site_geoms(t).select("site_id", "geom"), 30.0)
    return out.select("site_id", F.round(geo.area("geom"), 4).alias("area"))


@query(
    "b22_rows_per_key",
    "SELECT tile_id, count(*) AS n, round(sum(z), 4) AS sum_z FROM points GROUP BY tile_id",
)
def b22(t):
    """The work of one task per tile is one grouping by tile."""
    return t.points.groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("z"), 4).alias("sum_z"))


# --- scalar functions -------------------------------------------------------------------------------------------


@query(
    "h1_h2_h5_text",
    """SELECT tile_id, right(project, 4) AS suffix, try_cast(right(url, 4) AS INTEGER) AS not_a_year,
              split_part(list_extract(string_split(url, '/'), -1), '.', 1) AS stem, replace(url, '.copc.laz', '.tif') AS raster FROM tiles""",
)
def h_text(t):
    return t.tiles.select(
        "tile_id", F.right("project", F.lit(4)).alias("suffix"), tx.project_year("url").alias("not_a_year"),
        tx.file_stem("url").alias("stem"), tx.with_extension("url", ".copc.laz", ".tif").alias("raster"),
    )


@query(
    "h3_store_url",
    """SELECT page_id, split_part(regexp_extract(url, '^[a-z0-9]+://([^/?#]+)', 1), '.', 1) AS bucket,
              ltrim(regexp_extract(url, '^[a-z0-9]+://[^/?#]+([^?#]*)', 1), '/') AS key FROM pages""",
)
def h3(t):
    return t.pages.select("page_id", tx.store_bucket("url").alias("bucket"), tx.store_key("url").alias("key"))


@query(
    "h4_h13_band_rows",
    """SELECT vec_id, concat('A', lpad(CAST(i AS VARCHAR), 2, '0')) AS band, CAST(floor(i / 8) AS INTEGER) AS row,
              CAST(i % 8 AS INTEGER) AS col, v FROM (SELECT vec_id, unnest(range(0, 64)) AS i, unnest(embedding) AS v FROM embeddings)""",
)
def h4(t):
    """Band arrays as rows with padded names, and array position to row and column."""
    e = t.embeddings.select("vec_id", F.posexplode("embedding").alias("i", "v"))
    return e.select("vec_id", tx.band_name("i").alias("band"), F.floor(F.col("i") / 8).cast("int").alias("row"), (F.col("i") % 8).cast("int").alias("col"), "v")


@query(
    "h6_date_span",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'",
)
def h6(t):
    return t.orders.where(tx.in_year("o_orderdate", 1997)).select("o_orderkey", "o_orderdate")


@query(
    "h7_h12_math",
    """SELECT o_orderkey, CAST(ceil((o_orderkey % 11 + 1) / 66 * 50) AS INTEGER) AS share, CAST(floor(5000 / (o_custkey + 1)) AS INTEGER) AS whole,
              greatest(o_totalprice - 100000, 0) AS clamped, round(o_totalprice / 1000, 5) AS rounded FROM orders""",
)
def h7(t):
    from heightgrid.operators.sampling import allocation

    return t.orders.select(
        "o_orderkey", allocation(F.col("o_orderkey") % 11 + 1, 50, 11).alias("share"), (F.lit(5000) / (F.col("o_custkey") + 1)).cast("int").alias("whole"),
        F.greatest(F.col("o_totalprice") - 100000, F.lit(0.0)).alias("clamped"), F.round(F.col("o_totalprice") / 1000, 5).alias("rounded"),
    )


@query(
    "h8_z_score",
    """SELECT event_id, round((value - m) / d, 6) AS z FROM events CROSS JOIN (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events) k""",
)
def h8(t):
    from heightgrid.session import with_row

    m = t.events.agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("d"))
    z = F.when(F.col("d") > 0, (F.col("value") - F.col("m")) / F.col("d"))
    return with_row(t.events, m).select("event_id", F.round(z, 6).alias("z"))


@query(
    "h9_digitize",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
              CASE WHEN l_quantity <= 0 THEN 0 ELSE CAST(least(ceil(l_quantity / 5), 11) AS INTEGER) END AS bin,
              CASE WHEN l_discount <= 0 THEN 0 WHEN l_discount <= 0.03 THEN 1 WHEN l_discount <= 0.07 THEN 2 ELSE 3 END AS uneven FROM lineitem""",
)
def h9(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        grid.digitize("l_quantity", HEIGHT_EDGES).alias("bin"), grid.digitize("l_discount", (0, 0.03, 0.07)).alias("uneven"),
    )


@query(
    "h10_cover_strata",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN v > 0 AND v <= 0.3 THEN 'low' WHEN v > 0.3 AND v <= 0.5 THEN 'medium'
         WHEN v > 0.5 AND v <= 0.8 THEN 'high' WHEN v > 0.8 AND v <= 1 THEN 'full' END AS cover_strata
       FROM (SELECT *, l_quantity / 45 AS v FROM lineitem)""",
)
def h10(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", grid.cut(F.col("l_quantity") / 45, COVER_EDGES, COVER_LABELS).alias("cover_strata")
    )


@query("h11_bad_numbers", "SELECT vec_id, vec_id % 3 = 0 AS has_nan, vec_id % 5 = 0 AS has_inf FROM embeddings")
def h11(t):
    def put(i, value, every):
        return lambda v, k: F.when((k == i) & (F.col("vec_id") % every == 0), F.lit(float(value)).cast("float")).otherwise(v)

    v = F.transform(F.transform("embedding", put(7, "nan", 3)), put(60, "-inf", 5))
    df = t.embeddings.select("vec_id", v.alias("v"))
    return df.select(
        "vec_id", F.exists("v", F.isnan).alias("has_nan"), F.exists("v", lambda x: F.abs(x) == F.lit(float("inf"))).alias("has_inf")
    )


@query(
    "h14_explode_multipoint",
    """SELECT site_id, i, px + dx AS x, py + dy AS y FROM sites, LATERAL (
         SELECT 0 AS i, -half AS dx, 0.0 AS dy UNION ALL SELECT 1, 0, -half UNION ALL SELECT 2, half, 0 UNION ALL SELECT 3, 0, half) v""",
)
def h14(t):
    px, py, h = F.col("px"), F.col("py"), F.col("half")
    pts = F.array(*[F.array(F.array(geo.vertex(x, y))) for x, y in [(px - h, py), (px, py - h), (px + h, py), (px, py + h)]])
    g = t.sites.select("site_id", geo.geometry("MULTIPOINT", pts).alias("geom"))
    return g.select("site_id", F.posexplode(geo.vertices("geom")).alias("i", "v")).select("site_id", "i", "v.x", "v.y")


@query(
    "h15_c12_label_map",
    """SELECT id, strata, CASE WHEN strata = 11 THEN '>50' ELSE concat(strata * 5 - 5, '-', strata * 5) END AS label,
              CASE WHEN strata = 11 THEN NULL WHEN strata = 10 THEN '>50' ELSE concat(strata * 5, '-', strata * 5 + 5) END AS shifted FROM samples""",
)
def h15(t):
    """Labels by true interval, and with the offset that gives the next interval's label."""
    return t.samples.select(
        "id", "strata", grid.stratum_label("strata", HEIGHT_LABELS).alias("label"), grid.stratum_label("strata", HEIGHT_LABELS, 1).alias("shifted")
    )


@query(
    "h16_footer_json",
    "SELECT event_id, event_id % 60 + 32600 AS epsg, CAST(props ->> '$.k' AS INTEGER) AS k FROM events",
)
def h16(t):
    code = (F.col("event_id") % 60 + 32600).cast("string")
    doc = F.concat(F.lit('{"columns": {"geometry": {"encoding": "WKB", "crs": {"id": {"authority": "EPSG", "code": '), code, F.lit("}}}}}"))
    return t.events.select(
        "event_id", tx.geo_footer_epsg(doc).cast("long").alias("epsg"), F.get_json_object("props", "$.k").cast("int").alias("k")
    )


@query("h17_catalogue_latest", "SELECT event_id, concat('r-', props ->> '$.k') AS latest FROM events")
def h17(t):
    body = F.concat(F.lit('{"id": "catalogue", "latest": "r-'), F.get_json_object("props", "$.k"), F.lit('"}'))
    return t.events.select("event_id", tx.catalogue_latest(body).alias("latest"))


@query("h18_row_ids", "SELECT md5(concat(event_id, '|', user_id)) AS id, event_id FROM events")
def h18(t):
    return t.events.select(stable_id("event_id", "user_id").alias("id"), "event_id")


@query(
    "h19_h22_h24_boxes",
    """SELECT id, (xmax - xmin) * (ymax - ymin) AS area, xmin AS bx1, ymin AS by1, xmax AS bx2, ymax AS by2, 5 AS n_vertices FROM water""",
)
def h19(t):
    g = t.water.select("id", geo.box_geom().alias("geom"))
    return g.select(
        "id", geo.area("geom").alias("area"), geo.bbox("geom")["xmin"].alias("bx1"), geo.bbox("geom")["ymin"].alias("by1"),
        geo.bbox("geom")["xmax"].alias("bx2"), geo.bbox("geom")["ymax"].alias("by2"), F.size(geo.vertices("geom")).alias("n_vertices"),
    )


@query("h22_h23_h25_diamonds", "SELECT site_id, round(2 * half * half, 6) AS area, round(px, 6) AS x, round(py, 6) AS y, 'POLYGON' AS type, false AS is_empty FROM sites")
def h22(t):
    g = site_geoms(t)
    c = geo.centroid("geom")
    return g.select(
        "site_id", F.round(geo.area("geom"), 6).alias("area"), F.round(c["x"], 6).alias("x"), F.round(c["y"], 6).alias("y"),
        geo.geom_type("geom").alias("type"), geo.is_empty("geom").alias("is_empty"),
    )


@query(
    "h20_intersects",
    """SELECT w.id, s.site_id FROM water w JOIN sites s
       ON greatest(w.xmin - s.px, 0, s.px - w.xmax) + greatest(w.ymin - s.py, 0, s.py - w.ymax) <= s.half
       WHERE w.geom_type = 'POLYGON'""",
)
def h20(t):
    """Closed polygon test on water rectangles and site diamonds, which have no vertices in common."""
    water = t.water.where("geom_type = 'POLYGON'").select("id", geo.box_geom().alias("w_geom"), *BOX)
    pairs = bucket_pairs(water, site_geoms(t).select("site_id", "geom", *BOX))
    return pairs.where(geo.intersects("w_geom", "geom")).select("id", "site_id")


@query("h21_text_geometry", "SELECT site_id, round(2 * half * half, 6) AS area, px - half AS first_x, py AS first_y FROM sites")
def h21(t):
    """Geometry to WKT and WKB and back."""
    from heightgrid.functions.wkb import from_wkb, from_wkt, to_wkb, to_wkt

    g = site_geoms(t).select("site_id", from_wkt(to_wkt("geom")).alias("a")).select("site_id", to_wkb("a").alias("b"))
    g = g.select("site_id", from_wkb("b").alias("geom"))
    v = F.element_at(geo.vertices("geom"), 1)
    return g.select("site_id", F.round(geo.area("geom"), 6).alias("area"), v["x"].alias("first_x"), v["y"].alias("first_y"))
