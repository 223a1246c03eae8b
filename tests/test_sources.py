import json
import os
import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from heightgrid.functions.text import file_stem, store_bucket, store_key
from heightgrid.functions.wkb import from_wkt
from heightgrid.sources.inventory import cloud_optimised, footer_crs
from heightgrid.sources.outputs import pending, written_keys
from heightgrid.sources.rasters import cells_to_payload, payload_to_cells, write_cells
from heightgrid.sources.tables import csv_to_parquet, read_geoparquet, write_geoparquet


def las_bytes(user_id, extended=False):
    head = bytearray(375)
    head[:4], head[24], head[25] = b"LASF", 1, 4
    struct.pack_into("<H", head, 94, 375)
    if extended:
        struct.pack_into("<QI", head, 235, 375, 1)
        record = bytearray(60)
        record[2 : 2 + len(user_id)] = user_id
    else:
        struct.pack_into("<I", head, 100, 1)
        record = bytearray(54)
        record[2 : 2 + len(user_id)] = user_id
    return bytes(head + record)


def test_point_file_inventory(spark, tmp_path):
    files = {"a": las_bytes(b"copc"), "b": las_bytes(b"COPC", True), "c": las_bytes(b"other"), "d": b"no point file", "e": b""}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    paths = [(str(tmp_path / n),) for n in [*files, "missing"]]
    got = {r["path"].rsplit("/", 1)[1]: r["is_copc"] for r in cloud_optimised(spark.createDataFrame(paths, "path string")).collect()}
    assert got == {"a": True, "b": True, "c": False, "d": False, "e": False, "missing": False}


def test_footer_code(spark, tmp_path):
    geo = {"columns": {"geometry": {"crs": {"id": {"authority": "EPSG", "code": 32612}}}}}
    t = pa.table({"geometry": [b"x"]})
    pq.write_table(t.replace_schema_metadata({"geo": json.dumps(geo)}), tmp_path / "with.parquet")
    pq.write_table(t, tmp_path / "without.parquet")
    df = spark.createDataFrame([(str(tmp_path / f"{n}.parquet"),) for n in ("with", "without")], "path string")
    assert sorted((r["epsg"] for r in footer_crs(df).collect()), key=str) == [32612, None]


def test_rerun_is_a_no_op(spark, tmp_path):
    path = str(tmp_path / "cells")
    tiles = spark.range(4).select(F.col("id").alias("tile_id"))
    assert written_keys(spark, path, "tile_id") is None
    assert pending(tiles, None, ["tile_id"]).count() == 4
    write_cells(tiles.where("tile_id < 3").withColumns({"cx": F.lit(1), "cy": F.lit(1)}), path)
    left = pending(tiles, written_keys(spark, path, "tile_id"), ["tile_id"])
    assert [r["tile_id"] for r in left.collect()] == [3]
    write_cells(left.withColumns({"cx": F.lit(1), "cy": F.lit(1)}), path)
    assert pending(tiles, written_keys(spark, path, "tile_id"), ["tile_id"]).count() == 0


def test_payload_round_trip(spark):
    rows = [(1, x, y, float(x * 1000 + y)) for x in range(-5, 130, 7) for y in range(95, 110)]
    df = spark.createDataFrame(rows, "tile_id long, cx long, cy long, value double")
    packed = cells_to_payload(df, ["tile_id"])
    assert packed.where(F.size("values") != 10000).count() == 0
    assert sorted(tuple(r) for r in payload_to_cells(packed, ["tile_id"]).collect()) == sorted(rows)


def test_malformed_csv_rows_drop(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,value\n1,2.5\nbad,row\n3,4.5\n")
    out = csv_to_parquet(spark, str(tmp_path / "x.csv"), "id long, value double", str(tmp_path / "out"))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2.5), (3, 4.5)]
    bad = spark.read.parquet(str(tmp_path / "out_rejects")).collect()
    assert [(r["file"].rsplit("/", 1)[1], r["record"]) for r in bad] == [("x.csv", "bad,row")]


def test_footer_of_written_files(spark, tmp_path):
    path = str(tmp_path / "geo")
    df = spark.range(40).repartition(4).select("id", F.lit("extra").alias("name"), from_wkt(F.format_string("POLYGON((%1$d 0,%2$d 0,%2$d 5,%1$d 0))", F.col("id"), F.col("id") + 1)).alias("geom"))
    for mode, n in (("overwrite", 40), ("append", 80), ("overwrite", 40)):
        write_geoparquet(df, path, mode=mode, srid=32633)
        assert read_geoparquet(spark, path).count() == n
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert files and not os.path.exists(f"{path}/_attempts")
    got = footer_crs(spark.createDataFrame([(f"{path}/{f}",) for f in files], "path string"))
    assert {r["epsg"] for r in got.collect()} == {32633}
    boxes = [json.loads(pq.ParquetFile(f"{path}/{f}").metadata.metadata[b"geo"])["columns"]["geometry"]["bbox"] for f in files]
    assert min(b[0] for b in boxes) == 0 and max(b[2] for b in boxes) == 40 and {b[3] for b in boxes} == {5.0}
    with pytest.raises(FileExistsError):
        write_geoparquet(df, path, mode="error", srid=32633)
    write_geoparquet(df.where("id < 0"), path, srid=4326)
    assert read_geoparquet(spark, path).columns == ["id", "name", "bbox", "geom"] and spark.read.parquet(path).isEmpty()


def test_url_parts(spark):
    u = F.lit("https://bucket-x.s3.region.example.org/a/b/TILE_7.copc.laz")
    r = spark.range(1).select(store_bucket(u), store_key(u), file_stem(u)).first()
    assert tuple(r) == ("bucket-x", "a/b/TILE_7.copc.laz", "TILE_7")
