import math
import struct

import pytest
from pyspark.sql import functions as F

from heightgrid.functions import crs
from heightgrid.functions import geometry as geo
from heightgrid.functions.wkb import from_wkb, from_wkt, to_wkb, to_wkt, wkb_problem, wkb_srid


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def poly(*pts):
    return geo.polygon_from_xy([(F.lit(float(x)), F.lit(float(y))) for x, y in pts])


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]


def test_area_centroid_bounds(spark):
    r = one(spark, geo.area(poly((0, 0), (6, 0), (0, 3))).alias("a"), geo.centroid(poly((0, 0), (6, 0), (0, 3))).alias("c"), geo.bbox(poly(*SQUARE)).alias("b"))
    assert r["a"] == 9.0
    assert (round(r["c"]["x"], 9), round(r["c"]["y"], 9)) == (2.0, 1.0)
    assert tuple(r["b"]) == (0.0, 0.0, 10.0, 10.0)


def test_hole_counts_in_area_and_containment(spark):
    wkt = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"
    g = from_wkt(F.lit(wkt))
    r = one(spark, geo.area(g).alias("a"), geo.contains_xy(g, F.lit(5.0), F.lit(5.0)).alias("hole"), geo.contains_xy(g, F.lit(1.0), F.lit(1.0)).alias("ring"))
    assert (r["a"], r["hole"], r["ring"]) == (96.0, False, True)


def test_half_open_borders(spark):
    g = poly(*SQUARE)
    at = lambda x, y: geo.contains_xy(g, F.lit(float(x)), F.lit(float(y)))
    r = one(spark, at(0, 5).alias("left"), at(10, 5).alias("right"), at(5, 0).alias("low"), at(5, 10).alias("high"), geo.covers_xy(g, F.lit(10.0), F.lit(5.0)).alias("closed"))
    assert tuple(r) == (True, False, True, False, True)


@pytest.mark.parametrize(
    "other, meets",
    [
        ([(10, 10), (12, 10), (12, 12), (10, 12)], True),  # corner touch
        ([(2, 2), (3, 2), (3, 3), (2, 3)], True),  # inside
        ([(-5, -5), (20, -5), (20, 20), (-5, 20)], True),  # around
        ([(4, -5), (6, -5), (6, 15), (4, 15)], True),  # cross without vertices inside
        ([(11, 0), (12, 0), (12, 1), (11, 1)], False),
        ([(11, 9), (13, 9), (13, 13), (9, 13), (9, 12)], False),  # boxes overlap, shapes do not
    ],
)
def test_intersects(spark, other, meets):
    assert one(spark, geo.intersects(poly(*SQUARE), poly(*other)).alias("m"))["m"] is meets


def test_validity(spark):
    r = one(spark, geo.is_valid(poly(*SQUARE)).alias("ok"), geo.is_valid(poly((0, 0), (2, 2), (2, 0), (0, 2))).alias("bow"), geo.is_valid(poly((0, 0), (1, 0), (2, 0))).alias("flat"))
    assert tuple(r) == (True, False, False)


def test_clip(spark):
    tri = poly((0, 0), (10, 0), (0, 10))
    c = geo.clip_to_box(tri, *[F.lit(float(v)) for v in (0, 0, 5, 5)])
    outside = geo.clip_to_box(tri, *[F.lit(float(v)) for v in (20, 20, 25, 25)])
    r = one(spark, geo.area(c).alias("a"), geo.area(outside).alias("o"), geo.is_empty(outside).alias("e"))
    assert (r["a"], r["o"], r["e"]) == (25.0, 0.0, True)


@pytest.mark.parametrize(
    "wkt",
    [
        "POINT (1.5 -2.0)",
        "LINESTRING (0.0 0.0, 1.0 1.0)",
        "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 1.0))",
        "MULTIPOINT ((0.0 0.0), (1.0 2.0))",
        "MULTIPOLYGON (((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0)), ((5.0 5.0, 6.0 5.0, 6.0 6.0, 5.0 5.0)))",
    ],
)
def test_text_and_binary_round_trip(spark, wkt):
    df = spark.range(1).select(to_wkb(from_wkt(F.lit(wkt))).alias("b")).select(to_wkt(from_wkb("b")).alias("w"))
    assert df.first()["w"] == wkt


def test_binary_forms_and_rejects(spark):
    """Z, M, SRID, big-endian and mixed types in one column; what is no geometry has a reason and stops nothing."""
    d = lambda order, *v: struct.pack(f"{order}{len(v)}d", *v)
    point = struct.pack("<BI", 1, 1) + d("<", 1, 2)
    rows = {
        "iso z": (struct.pack("<BI", 1, 1001) + d("<", 1, 2, 9), "POINT (1.0 2.0)", None, None),
        "iso zm": (struct.pack("<BI", 1, 3001) + d("<", 1, 2, 9, 8), "POINT (1.0 2.0)", None, None),
        "flags": (struct.pack("<BII", 1, 1 | 0xE0000000, 32633) + d("<", 1, 2, 9, 8), "POINT (1.0 2.0)", None, 32633),
        "big": (struct.pack(">BII", 0, 1002, 2) + d(">", 0, 0, 7, 1, 1, 7), "LINESTRING (0.0 0.0, 1.0 1.0)", None, None),
        "mixed order": (struct.pack(">BII", 0, 4, 1) + point, "MULTIPOINT ((1.0 2.0))", None, None),
        "collection": (struct.pack("<BII", 1, 7, 0), None, "unsupported", None),
        "cut": (point[:-3], None, "buffer", None),
        "more": (point + b"x", None, "behind", None),
        "member": (struct.pack("<BII", 1, 6, 1) + point, None, "inside", None),
        "empty": (b"", None, "range", None),
        "null": (None, None, None, None),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in rows.items()], "k string, b binary").coalesce(1)
    out = df.select("k", to_wkt(from_wkb("b")).alias("w"), wkb_problem("b").alias("p"), wkb_srid("b").alias("s"), to_wkb(from_wkb("b")).alias("back"))
    for r in out.collect():
        _, text, reason, srid = rows[r["k"]]
        assert (r["w"], r["s"], r["back"] is None) == (text, srid, text is None), r["k"]
        assert r["p"] is None if reason is None else reason in r["p"], (r["k"], r["p"])
    assert df.where("k = ''").select(from_wkb("b").alias("g")).isEmpty()


def test_known_utm_position_and_round_trip(spark):
    # on the central meridian the easting is 500 km; the equator has northing 0
    x, y = crs.reproject_xy(F.lit(15.0), F.lit(0.0), 4326, 32633)
    r = one(spark, x.alias("x"), y.alias("y"))
    assert abs(r["x"] - 500000) < 1e-6 and abs(r["y"]) < 1e-6
    df = spark.range(0, 50).selectExpr("12.1D + id * 0.117D AS lon", "-70 + id * 3D AS lat")
    for epsg in (32633, 32733):
        x, y = crs.reproject_xy(F.col("lon"), F.col("lat"), 4326, epsg)
        back = df.select("lon", "lat", x.alias("x"), y.alias("y"))
        lon, lat = crs.reproject_xy(F.col("x"), F.col("y"), epsg, 4326)
        worst = back.agg(F.max(F.abs(lon - F.col("lon")) + F.abs(lat - F.col("lat"))).alias("w")).first()["w"]
        assert worst < 1e-9  # under a tenth of a millimetre


def test_scale_on_meridian(spark):
    """Length of a meridian arc from 0 to 45 degrees on WGS84 is 4,984,944.378 m."""
    _, y = crs.reproject_xy(F.lit(15.0), F.lit(45.0), 4326, 32633)
    assert math.isclose(one(spark, y.alias("y"))["y"] / 0.9996, 4984944.378, abs_tol=0.01)


def test_other_crs_raises():
    with pytest.raises(ValueError):
        crs.reproject_xy(F.lit(0.0), F.lit(0.0), 4326, 3857)
