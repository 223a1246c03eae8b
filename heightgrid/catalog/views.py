"""Survey-like views over the test tables; their extent grows with the tables.

A tile is a square of 100 m (one per supplier), ten tiles to a row. ``TEXT`` holds SQL that
both Spark and the oracle engine read; ``{name}`` stands for a base table or another view.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TEXT: dict[str, str] = {}

# point cloud: about six points per 10 m cell, on a 1 m lattice
TEXT["points"] = """
SELECT tile_id, l_orderkey, l_linenumber, l_partkey, x, y,
       CAST(floor(x / 10) AS BIGINT) AS cx, CAST(floor(y / 10) AS BIGINT) AS cy,
       classification, ground_z, hag, ground_z + hag AS z
FROM (SELECT l_suppkey AS tile_id, l_orderkey, l_linenumber, l_partkey, x, y,
             CASE WHEN l_returnflag = 'N' THEN 2 ELSE 5 END AS classification,
             200 + CAST(floor((x - 500000) / 20) AS DOUBLE) / 2 AS ground_z,
             CASE WHEN l_returnflag = 'N' THEN CAST(0 AS DOUBLE)
                  ELSE least(CAST(floor(abs((x - 500000) % 80 - 40) / 40 * 35) AS DOUBLE) + l_quantity / 2,
                             CAST(60 AS DOUBLE)) END AS hag
      FROM (SELECT *,
                   CAST(500000 + (l_suppkey % 10) * 100
                        + (l_partkey * 37 + l_linenumber * 11 + l_orderkey * 3) % 100 AS DOUBLE)
                     + CAST(0.5 AS DOUBLE) AS x,
                   CAST(6500000 + CAST(floor(l_suppkey / 10) AS BIGINT) * 100
                        + (l_orderkey * 53 + l_partkey * 7) % 100 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS y
            FROM {lineitem}) a) b
"""

# tile index: one square of 100 m per supplier
TEXT["tiles"] = """
SELECT s_suppkey AS tile_id, concat('TILE_', s_suppkey) AS tile_name,
       concat('PROJECT_', 2015 + s_nationkey % 5) AS project,
       concat('https://pointstore.example.org/dir/TILE_', s_suppkey, '.copc.laz') AS url,
       CAST(500000 + (s_suppkey % 10) * 100 AS DOUBLE) AS xmin,
       CAST(6500000 + CAST(floor(s_suppkey / 10) AS BIGINT) * 100 AS DOUBLE) AS ymin,
       CAST(500100 + (s_suppkey % 10) * 100 AS DOUBLE) AS xmax,
       CAST(6500100 + CAST(floor(s_suppkey / 10) AS BIGINT) * 100 AS DOUBLE) AS ymax
FROM {supplier}
"""

# area polygons: one diamond per customer, given by centre and half width
TEXT["sites"] = """
SELECT c_custkey AS site_id, c_mktsegment AS site_name,
       CAST(500000 + (c_custkey * 37) % 1000 AS DOUBLE) AS px,
       CAST(6500000 + CAST(floor(c_custkey / 150) AS BIGINT) * 100 + (c_custkey * 53) % 100 AS DOUBLE) AS py,
       CAST(20 + (c_custkey % 5) * 15 AS DOUBLE) AS half
FROM {customer}
"""

# water features: small rectangles of mixed geometry type, one per part
TEXT["water"] = """
SELECT p_partkey AS id,
       CASE WHEN p_partkey % 7 = 0 THEN 'LINESTRING' WHEN p_partkey % 11 = 0 THEN 'POINT' ELSE 'POLYGON' END
         AS geom_type,
       p_type AS subtype,
       CAST(500000 + (p_partkey * 97) % 1000 AS DOUBLE) AS xmin,
       CAST(6500000 + CAST(floor(p_partkey / 200) AS BIGINT) * 100 + (p_partkey * 61) % 100 AS DOUBLE) AS ymin,
       CAST(500004 + (p_partkey * 97) % 1000 + p_size % 16 AS DOUBLE) AS xmax,
       CAST(6500004 + CAST(floor(p_partkey / 200) AS BIGINT) * 100 + (p_partkey * 61) % 100 + p_size % 12 AS DOUBLE)
         AS ymax
FROM {part}
"""

# dated three-band forest images on the 10 m grid; pixels overlap between images
TEXT["forest_images"] = """
SELECT image_id, image_date, 50000 + r % 100 AS cx, 650000 + band * 10 + CAST(floor(r % 1000 / 100) AS BIGINT) AS cy,
       CASE WHEN (image_id * 7919) % 100
                 < ((CAST(floor(r % 100 / 10) AS BIGINT) * 13 + band * 29) % 101) THEN 10 ELSE 127 END AS b1,
       CASE WHEN image_id % 29 = 0 THEN 20 ELSE 127 END AS b2,
       CASE WHEN image_id % 31 = 0 THEN 30 ELSE 127 END AS b3
FROM (SELECT o_orderkey AS image_id, o_orderdate AS image_date, CAST(floor(o_orderkey / 1500) AS BIGINT) AS band,
             o_orderkey % 1500 AS r
      FROM {orders}) o
"""

# dated single-band image stack: about ten images per pixel
TEXT["images"] = """
SELECT event_id AS image_id, ts AS image_date, event_type AS sensor, user_id % 50 AS cx,
       CAST(floor(event_id / 1000) AS BIGINT) * 2 + event_id % 2 AS cy, value
FROM {events}
"""

# 64-band embedding raster on the cells that hold points
TEXT["emb_px"] = """
SELECT p.tile_id, p.cx, p.cy, e.vec_id, e.label, e.embedding
FROM (SELECT c.tile_id, c.cx, c.cy, (c.cx * 31 + c.cy * 17) % k.n AS vec_key
      FROM (SELECT DISTINCT tile_id, cx, cy FROM {points}) c
      CROSS JOIN (SELECT count(*) AS n FROM {embeddings}) k) p
JOIN {embeddings} e ON e.vec_id = p.vec_key
"""

# model evaluation inputs
TEXT["cv_results"] = """
SELECT o_orderpriority AS model, o_custkey % 5 + 1 AS folds,
       CAST(1 AS DOUBLE) - avg(o_totalprice) / 1000000 AS r2,
       avg(o_totalprice) / 100000 AS rmse, stddev_samp(o_totalprice) / 100000 AS mae
FROM {orders} GROUP BY 1, 2
"""
TEXT["cv_preds"] = """
SELECT l_returnflag AS model, l_suppkey % 5 + 1 AS folds, l_quantity AS y_true, l_extendedprice / 2100 AS y_pred
FROM {lineitem}
"""

_NAME = re.compile(r"\{(\w+)\}")

DUCK_VIEWS: dict[str, str] = {k: _NAME.sub(r"\1", v) for k, v in TEXT.items()}

# height grid, samples and fold blocks, as the oracle engine derives them
DUCK_VIEWS["chm"] = """
SELECT tile_id, cx, cy, round(quantile_cont(hag, 0.95), 6) AS height, count(*) AS n
FROM points WHERE hag BETWEEN 0 AND 50 GROUP BY ALL
"""
DUCK_VIEWS["strata_px"] = """
SELECT tile_id, cx, cy, height,
       CAST(least(ceil(height / 5), 11) AS INTEGER) AS strata
FROM chm WHERE height > 0
"""
DUCK_VIEWS["samples"] = """
SELECT md5(concat(tile_id, '|', cx, '|', cy)) AS id, tile_id, strata,
       CAST(cx * 10 + 5 AS DOUBLE) AS x, CAST(cy * 10 + 5 AS DOUBLE) AS y, height
FROM strata_px
"""
DUCK_VIEWS["forest_px"] = """
SELECT cx, cy, CASE WHEN b1 <> 127 OR b2 <> 127 OR b3 <> 127 THEN 1 ELSE 0 END AS forest
FROM (SELECT *, row_number() OVER (PARTITION BY cx, cy ORDER BY image_date DESC, image_id DESC) AS rn
      FROM forest_images) WHERE rn = 1
"""
DUCK_VIEWS["tile_cover"] = """
SELECT t.*, round(c.cover, 6) AS cover FROM tiles t JOIN (
  SELECT t.tile_id, avg(f.forest) AS cover
  FROM tiles t JOIN forest_px f ON f.cx * 10 + 5 >= t.xmin AND f.cx * 10 + 5 < t.xmax
                               AND f.cy * 10 + 5 >= t.ymin AND f.cy * 10 + 5 < t.ymax
  GROUP BY t.tile_id) c USING (tile_id)
"""
DUCK_VIEWS["tile_blocks"] = """
SELECT t.tile_id, t.cover,
       CASE WHEN t.cover > 0 AND t.cover <= 0.3 THEN 'low' WHEN t.cover > 0.3 AND t.cover <= 0.5 THEN 'medium'
            WHEN t.cover > 0.5 AND t.cover <= 0.8 THEN 'high' WHEN t.cover > 0.8 AND t.cover <= 1 THEN 'full'
       END AS cover_strata,
       b.bcol, b.brow, b.folds, greatest(t.xmin, b.xmin) AS xmin, greatest(t.ymin, b.ymin) AS ymin,
       least(t.xmax, b.xmax) AS xmax, least(t.ymax, b.ymax) AS ymax
FROM tile_cover t JOIN blocks b
  ON t.xmin < b.xmax AND t.xmax > b.xmin AND t.ymin < b.ymax AND t.ymax > b.ymin
"""
DUCK_VIEWS["blocks"] = """
SELECT bcol, brow, x0 + bcol * 250 AS xmin, y0 + brow * 250 AS ymin, x0 + (bcol + 1) * 250 AS xmax, y0 + (brow + 1) * 250 AS ymax,
       CAST((row_number() OVER (ORDER BY md5(concat('420|', bcol, '|', brow))) - 1) % 5 + 1 AS INTEGER) AS folds
FROM (SELECT DISTINCT b.x0, b.y0, i.bcol, j.brow
      FROM (SELECT min(xmin) AS x0, min(ymin) AS y0, max(xmax) AS x1, max(ymax) AS y1 FROM tiles) b,
           LATERAL (SELECT unnest(range(0, CAST(ceil((b.x1 - b.x0) / 250) AS BIGINT))) AS bcol) i,
           LATERAL (SELECT unnest(range(0, CAST(ceil((b.y1 - b.y0) / 250) AS BIGINT))) AS brow) j,
           tiles t
      WHERE t.xmin <= b.x0 + (i.bcol + 1) * 250 AND t.xmax >= b.x0 + i.bcol * 250
        AND t.ymin <= b.y0 + (j.brow + 1) * 250 AND t.ymax >= b.y0 + j.brow * 250) g
"""

_ORDER = (
    "points tiles sites water forest_images images emb_px cv_results cv_preds "
    "chm strata_px samples forest_px tile_cover blocks tile_blocks"
).split()


def needed_views(sql: str) -> list[str]:
    """The views a text uses, directly or through others, in definition order."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in _ORDER:
            if name not in found and re.search(rf"(?i)\b(from|join|,)\s+{name}\b", text):
                found.add(name)
                todo.append(DUCK_VIEWS[name])
    return [n for n in _ORDER if n in found]


class Tables:
    """Base tables and derived views of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str, **extra: DataFrame) -> DataFrame:
        """Run SQL whose ``{name}`` placeholders are base tables, views or ``extra`` frames."""
        names = set(_NAME.findall(text)) - set(extra)
        return self.spark.sql(text, **{n: getattr(self, n) for n in names}, **extra)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TEXT:
            return self.sql(TEXT[name])
        if name in BASE:
            return self.base(name)
        raise AttributeError(name)

    @cached_property
    def chm(self) -> DataFrame:
        from heightgrid.operators.points import height_grid

        return height_grid(self.points, "P95", max_height=50.0)

    @cached_property
    def strata_px(self) -> DataFrame:
        from heightgrid.operators.grid import stratify
        from heightgrid.settings import HEIGHT_EDGES

        return stratify(self.chm.select("tile_id", "cx", "cy", "height"), "height", HEIGHT_EDGES)

    @cached_property
    def samples(self) -> DataFrame:
        return self.sql(
            """SELECT md5(concat(tile_id, '|', cx, '|', cy)) AS id, tile_id, strata,
                      CAST(cx * 10 + 5 AS DOUBLE) AS x, CAST(cy * 10 + 5 AS DOUBLE) AS y, height
               FROM {strata_px}"""
        )

    @cached_property
    def forest_px(self) -> DataFrame:
        from heightgrid.operators.mosaic import forest_mask, mosaic

        return forest_mask(mosaic(self.forest_images, ["b1", "b2", "b3"])).select("cx", "cy", "forest")

    @cached_property
    def tile_cover(self) -> DataFrame:
        from pyspark.sql import functions as F

        from heightgrid.operators.spatial_join import zonal_mean

        cover = zonal_mean(self.tiles, self.forest_px, "forest", 10.0, zone_keys=["tile_id"], out="cover")
        return self.tiles.join(cover, "tile_id").withColumn("cover", F.round("cover", 6))

    @cached_property
    def blocks(self) -> DataFrame:
        from heightgrid.operators.sampling import spatial_blocks

        return spatial_blocks(self.tiles, 250.0, 250.0, n_folds=5, seed=420)

    @cached_property
    def tile_blocks(self) -> DataFrame:
        from heightgrid.operators.grid import cut
        from heightgrid.operators.spatial_join import overlay_boxes_grid
        from heightgrid.settings import COVER_EDGES, COVER_LABELS

        pairs = overlay_boxes_grid(self.tile_cover, self.blocks, 250.0, 250.0)
        return pairs.select(
            "tile_id", "cover", cut("cover", COVER_EDGES, COVER_LABELS).alias("cover_strata"),
            "bcol", "brow", "folds", "xmin", "ymin", "xmax", "ymax",
        )
