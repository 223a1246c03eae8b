"""Stratified samples and spatial folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from heightgrid.catalog.registry import query
from heightgrid.operators import sampling as sm
from heightgrid.operators.grid import stratum_label
from heightgrid.settings import HEIGHT_LABELS

_U = "CAST('0x' || substr({h}, {at}, 8) AS BIGINT) / 4294967296.0"

_STRATIFIED = """
WITH g AS (SELECT * FROM tile_blocks WHERE cover_strata IS NOT NULL),
 lim AS (SELECT least(min(c), 20) AS n FROM (SELECT count(*) AS c FROM g GROUP BY cover_strata, folds)),
 r AS (SELECT *, row_number() OVER (PARTITION BY cover_strata, folds
              ORDER BY md5(concat_ws('|', '420', tile_id, bcol, brow)), tile_id, bcol, brow) AS rn FROM g)
"""


@query("i1_stratified_sample", _STRATIFIED + "SELECT tile_id, bcol, brow, folds, cover_strata FROM r CROSS JOIN lim WHERE rn <= lim.n")
def i1(t):
    g = t.tile_blocks.where("cover_strata IS NOT NULL").select("tile_id", "bcol", "brow", "folds", "cover_strata")
    return sm.stratified_sample(g, ["cover_strata", "folds"], 420, ["tile_id", "bcol", "brow"], 20)


@query(
    "i1_stratified_points",
    """WITH lim AS (SELECT least(min(c), 50) AS n FROM (SELECT count(*) AS c FROM points GROUP BY tile_id, classification)),
            r AS (SELECT *, row_number() OVER (PARTITION BY tile_id, classification ORDER BY
                    md5(concat_ws('|', '420', l_orderkey, l_linenumber, l_partkey)), l_orderkey, l_linenumber, l_partkey) AS rn FROM points)
       SELECT tile_id, classification, l_orderkey, l_linenumber, l_partkey FROM r CROSS JOIN lim WHERE rn <= lim.n""",
)
def i1_points(t):
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    return sm.stratified_sample(t.points.select("tile_id", "classification", *ids), ["tile_id", "classification"], 420, ids, 50)


@query(
    "i2_points_per_tile",
    _STRATIFIED + "SELECT count(*) AS tiles, CAST(floor(5000 / count(*)) AS INTEGER) AS points_per_tile FROM r CROSS JOIN lim WHERE rn <= lim.n",
)
def i2(t):
    return sm.points_per_tile(i1(t), 5000)


@query(
    "i3_allocation",
    "SELECT tile_id, strata, CAST(ceil(strata / 66 * 50) AS INTEGER) AS n_points FROM strata_px GROUP BY tile_id, strata",
)
def i3(t):
    s = t.strata_px.select("tile_id", "strata").distinct()
    return s.withColumn("n_points", sm.allocation("strata", 50, 11))


@query(
    "i4_random_points",
    f"""WITH c AS (SELECT tile_id, strata, cx, cy, row_number() OVER (PARTITION BY tile_id, strata
                     ORDER BY md5(concat_ws('|', '420', tile_id, strata, cx, cy))) - 1 AS rank,
                     count(*) OVER (PARTITION BY tile_id, strata) AS cells FROM strata_px),
            n AS (SELECT tile_id, strata, CAST(ceil(strata / 66 * 50) AS INTEGER) AS k, max(cells) AS cells FROM c GROUP BY tile_id, strata),
            d AS (SELECT *, md5(concat_ws('|', '420', tile_id, strata, draw)) AS h
                  FROM (SELECT n.tile_id, n.strata, n.cells, CAST(unnest(range(1, k + 1)) AS INTEGER) AS draw FROM n)),
            u AS (SELECT *, CAST(floor({_U.format(h='h', at=1)} * cells) AS BIGINT) AS rank, {_U.format(h='h', at=9)} AS u2,
                         {_U.format(h='h', at=17)} AS u3 FROM d)
       SELECT u.tile_id, u.strata, u.draw, round((c.cx + u2) * 10, 4) AS x, round((c.cy + u3) * 10, 4) AS y,
              CASE WHEN u.strata = 11 THEN '>50' ELSE concat(u.strata * 5 - 5, '-', u.strata * 5) END AS label
       FROM u JOIN c USING (tile_id, strata, rank)""",
)
def i4(t):
    cells = t.strata_px.select("tile_id", "strata", "cx", "cy")
    counts = cells.select("tile_id", "strata").distinct().withColumn("n", sm.allocation("strata", 50, 11))
    pts = sm.random_points(cells, ["tile_id", "strata"], counts, "n", 10.0, 420)
    return pts.select(
        "tile_id", "strata", "draw", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), stratum_label("strata", HEIGHT_LABELS).alias("label")
    )


@query(
    "i5_one_per_fold",
    """SELECT folds, tile_id, bcol, brow FROM (SELECT *, row_number() OVER (PARTITION BY folds
         ORDER BY md5(concat_ws('|', '420', tile_id, bcol, brow)), tile_id, bcol, brow) AS rn FROM tile_blocks) WHERE rn = 1""",
)
def i5(t):
    g = t.tile_blocks.select("folds", "tile_id", "bcol", "brow")
    return sm.sample_per_group(g, ["folds"], 1, 420, ["tile_id", "bcol", "brow"])


@query(
    "i6_resample",
    f"""WITH f AS (SELECT s.id, s.strata, s.height, b.folds FROM samples s JOIN blocks b ON s.x >= b.xmin AND s.x < b.xmax AND s.y >= b.ymin AND s.y < b.ymax),
            r AS (SELECT *, row_number() OVER (PARTITION BY folds, strata ORDER BY md5(concat_ws('|', '420', id))) - 1 AS rank,
                         count(*) OVER (PARTITION BY folds, strata) AS size FROM f),
            d AS (SELECT folds, strata, size, CAST(unnest(range(1, 51)) AS INTEGER) AS draw FROM (SELECT DISTINCT folds, strata, size FROM r)),
            k AS (SELECT folds, strata, draw, CAST(floor({_U.format(h="md5(concat_ws('|', '420', folds, strata, draw))", at=1)} * size) AS BIGINT) AS rank FROM d)
       SELECT k.folds, k.strata, k.draw, r.id, r.height FROM k JOIN r USING (folds, strata, rank)""",
)
def i6(t):
    from heightgrid.operators.spatial_join import points_to_grid_blocks

    f = points_to_grid_blocks(t.samples, t.blocks, 250.0, 250.0).select("id", "strata", "height", "folds")
    return sm.resample_groups(f, ["folds", "strata"], 50, 420, ["id"])


@query("i7_spatial_blocks", "SELECT bcol, brow, xmin, ymin, xmax, ymax, folds FROM blocks")
def i7(t):
    return t.blocks


@query(
    "i7_continuous_blocks",
    """SELECT bcol, brow, CAST((row_number() OVER (ORDER BY brow DESC, bcol) - 1) % 5 + 1 AS INTEGER) AS folds FROM blocks""",
)
def i7_continuous(t):
    return sm.spatial_blocks(t.tiles, 250.0, 250.0, 5, method="continuous").select("bcol", "brow", "folds")
