"""Sources and sinks: each query writes a table to the shared folder where it needs one, and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from heightgrid.catalog.filters_queries import site_geoms
from heightgrid.catalog.registry import query
from heightgrid.functions import geometry as geo
from heightgrid.functions.wkb import to_wkt
from heightgrid.operators.mosaic import images_between, mosaic
from heightgrid.operators.spatial_join import BOX
from heightgrid.operators.stats import describe
from heightgrid.session import scratch_path, with_row
from heightgrid.sources import outputs, rasters, tables
from heightgrid.sources.inventory import footer_crs


@query(
    "a1_a2_geoparquet",
    """SELECT site_id, site_name, round(2 * half * half, 6) AS area FROM sites
       WHERE px - half <= 500400 AND px + half >= 500100 AND py - half <= 6500080""",
)
def a1(t):
    """Write polygons as WKB with box columns; read them back through a filter on the boxes."""
    path = scratch_path(t.spark, "geoparquet")
    tables.write_geoparquet(site_geoms(t).select("site_id", "site_name", "geom"), path, sort_cell=100.0)
    df = tables.read_geoparquet(t.spark, path, 32633)
    hit = df.where("bbox.xmin <= 500400 AND bbox.xmax >= 500100 AND bbox.ymin <= 6500080")
    return hit.select("site_id", "site_name", F.round(geo.area("geom"), 6).alias("area"))


@query(
    "a3_merge_directory",
    "SELECT site_id, 4326 AS srid, round(2 * half * half, 6) AS area, 'POLYGON' AS type FROM sites",
)
def a3(t):
    """All files of a directory as one table, geometry rebuilt from text."""
    path = scratch_path(t.spark, "directory")
    site_geoms(t).select("site_id", to_wkt("geom").alias("wkt")).repartition(4).write.parquet(path)
    df = tables.read_directory(t.spark, path)
    return df.select("site_id", "srid", F.round(geo.area("geom"), 6).alias("area"), geo.geom_type("geom").alias("type"))


@query(
    "a4_fold_directory",
    "SELECT vec_id, CAST(vec_id % 5 + 1 AS INTEGER) AS folds, embedding[1] AS a0, embedding[64] AS a63 FROM embeddings",
)
def a4(t):
    """One folder per fold, scanned as one table; the fold comes from the folder name."""
    path = scratch_path(t.spark, "folds")
    e = t.embeddings.select("vec_id", (F.col("vec_id") % 5 + 1).cast("int").alias("folds"), "embedding")
    e.write.partitionBy("folds").parquet(path)
    return tables.read_directory(t.spark, path, wkt=None).select(
        "vec_id", "folds", F.col("embedding")[0].alias("a0"), F.col("embedding")[63].alias("a63")
    )


@query(
    "a5_hive_scan",
    """SELECT id, geom_type, xmin, ymin FROM water WHERE subtype = 'STANDARD' AND geom_type NOT IN ('LINESTRING', 'POINT')
       AND xmin BETWEEN 500100 AND 500800 AND ymin BETWEEN 6500000 AND 6500700""",
)
def a5(t):
    """Partition filter prunes folders; the box filter is pushed to the files."""
    path = scratch_path(t.spark, "hive")
    t.water.write.partitionBy("subtype").parquet(path)
    kept = tables.read_hive(t.spark, path, ["id", "geom_type", *BOX], F.col("subtype") == "STANDARD")
    return tables.select_water(kept, (500100, 6500000, 500800, 6500700), "corner").select("id", "geom_type", "xmin", "ymin")


@query("a8_band_scan", "SELECT tile_id, cx, cy, height FROM chm WHERE height <> 0")
def a8(t):
    """Dense payloads to cells; the nodata value becomes an absent row."""
    packed = rasters.cells_to_payload(t.chm.select("tile_id", "cx", "cy", "height"), ["tile_id"], "height")
    return rasters.payload_to_cells(packed, ["tile_id"], "height", nodata=0.0).select("tile_id", "cx", "cy", "height")


@query(
    "a9_raster_sink",
    """SELECT tile_id, CAST(floor(cx / 100) * 100 AS BIGINT) AS col0, CAST(floor(cy / 100) * 100 AS BIGINT) AS row0,
              count(*) AS n_cells, round(sum(height), 4) AS total FROM chm GROUP BY ALL""",
)
def a9(t):
    """Cells written in order of the tile, read back, and packed to dense payloads."""
    path = scratch_path(t.spark, "raster")
    rasters.write_cells(t.chm.select("tile_id", "cx", "cy", "height"), path)
    back = rasters.read_cells(t.spark, path).select(F.col("tile_id").cast("long").alias("tile_id"), "cx", "cy", "height")
    packed = rasters.cells_to_payload(back, ["tile_id"], "height")
    full = F.filter("values", lambda v: v.isNotNull())
    return packed.select(
        "tile_id", "col0", "row0", F.size(full).cast("long").alias("n_cells"),
        F.round(F.aggregate(full, F.lit(0.0), lambda a, v: a + v), 4).alias("total"),
    )


@query(
    "a10_image_scan",
    """SELECT cx, cy, value FROM (SELECT *, row_number() OVER (PARTITION BY cx, cy ORDER BY image_date DESC, image_id DESC) AS rn
         FROM images WHERE image_date >= TIMESTAMP '2024-01-05' AND image_date < TIMESTAMP '2024-01-20' AND cx BETWEEN 5 AND 40 AND cy BETWEEN 0 AND 12)
       WHERE rn = 1""",
)
def a10(t):
    import datetime as dt

    picked = images_between(t.images, dt.date(2024, 1, 5), dt.date(2024, 1, 20), (5, 0, 40, 12))
    return mosaic(picked, ["value"])


@query("a17_footer_crs", "SELECT 32633 AS epsg, count(*) AS sites, round(sum(2 * half * half), 4) AS area FROM sites")
def a17(t):
    """Sites written with a footer entry in each file; the code read back from every footer, the rows from every file."""
    path = scratch_path(t.spark, "geofooter")
    tables.write_geoparquet(site_geoms(t).select("site_id", "geom"), path, sort_cell=100.0, srid=32633)
    files = t.spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path")).distinct()
    codes = footer_crs(files).groupBy("epsg").agg(F.count(F.lit(1)).alias("files"))
    rows = tables.read_geoparquet(t.spark, path).agg(F.count(F.lit(1)).alias("sites"), F.round(F.sum(geo.area("geom")), 4).alias("area"))
    return with_row(codes.select("epsg"), rows)


@query("a11_csv_to_parquet", "SELECT event_id, user_id, value FROM events")
def a11(t):
    """Samples exported as CSV, read with a declared schema, kept as Parquet."""
    csv, out = scratch_path(t.spark, "csv"), scratch_path(t.spark, "parquet")
    t.events.select("event_id", "user_id", "value").write.option("header", True).csv(csv)
    return tables.csv_to_parquet(t.spark, csv, "event_id long, user_id long, value double", out)


@query(
    "a12_stats_csv",
    """SELECT count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
              round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
              round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max FROM events""",
)
def a12(t):
    path = scratch_path(t.spark, "stats")
    tables.write_stats(describe(t.events, "value"), path)
    schema = "count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    return t.spark.read.option("header", True).schema(schema).csv(path)


@query(
    "a13_latest_run",
    """SELECT o_orderpriority AS project, CAST(max_by(o_orderkey, (o_orderdate, o_orderkey)) AS VARCHAR) AS experiment_id, max(o_orderdate) AS created_at
       FROM orders GROUP BY o_orderpriority""",
)
def a13(t):
    runs = t.orders.select(F.col("o_orderpriority").alias("project"), F.col("o_orderkey").alias("experiment_id"), F.col("o_orderdate").alias("created_at"))
    path = scratch_path(t.spark, "registry")
    outputs.register_run(t.spark, path, runs.where("experiment_id % 2 = 0"))
    outputs.register_run(t.spark, path, runs.where("experiment_id % 2 = 1"))
    return outputs.latest_runs(t.spark.read.parquet(path)).withColumn("experiment_id", F.col("experiment_id").cast("string"))


@query(
    "a15_unfinished",
    "SELECT tile_id, tile_name FROM tiles WHERE tile_id NOT IN (SELECT tile_id FROM points WHERE hag > 58.4)",
)
def a15(t):
    """Tiles that are not written yet."""
    path = scratch_path(t.spark, "done")
    rasters.write_cells(t.points.where("hag > 58.4").select("tile_id", "cx", "cy", "hag"), path)
    done = outputs.written_keys(t.spark, path, "tile_id")
    return outputs.pending(t.tiles.select("tile_id", "tile_name"), done, ["tile_id"])
