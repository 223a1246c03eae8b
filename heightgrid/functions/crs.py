"""UTM projection both ways by Krueger's series, as plain column arithmetic (WGS84)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heightgrid.functions.geometry import bind, vertex

# WGS84 ellipsoid and UTM grid constants.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING = 10000000.0

_N = FLATTENING / (2 - FLATTENING)
_E = (FLATTENING * (2 - FLATTENING)) ** 0.5
_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)

# Published series coefficients of order six in the third flattening n.
_FORWARD = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180 - 127 * _N**5 / 288 + 7891 * _N**6 / 37800,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440 + 281 * _N**5 / 630 - 1983433 * _N**6 / 1935360,
    61 * _N**3 / 240 - 103 * _N**4 / 140 + 15061 * _N**5 / 26880 + 167603 * _N**6 / 181440,
    49561 * _N**4 / 161280 - 179 * _N**5 / 168 + 6601661 * _N**6 / 7257600,
    34729 * _N**5 / 80640 - 3418889 * _N**6 / 1995840,
    212378941 * _N**6 / 319334400,
)
_INVERSE = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360 - 81 * _N**5 / 512 + 96199 * _N**6 / 604800,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440 + 46 * _N**5 / 105 - 1118711 * _N**6 / 3870720,
    17 * _N**3 / 480 - 37 * _N**4 / 840 - 209 * _N**5 / 4480 + 5569 * _N**6 / 90720,
    4397 * _N**4 / 161280 - 11 * _N**5 / 504 - 830251 * _N**6 / 7257600,
    4583 * _N**5 / 161280 - 108847 * _N**6 / 3991680,
    20648693 * _N**6 / 638668800,
)


def utm_epsg(lon, lat) -> Column:
    """EPSG code of the UTM zone that holds a position."""
    lon, lat = (F.col(c) if isinstance(c, str) else c for c in (lon, lat))
    zone = F.least(F.greatest(F.floor((lon + 180) / 6) + 1, F.lit(1)), F.lit(60))
    return (F.when(lat >= 0, F.lit(32600)).otherwise(F.lit(32700)) + zone).cast("int")


def estimate_utm(layer: DataFrame, xmin="xmin", ymin="ymin", xmax="xmax", ymax="ymax") -> DataFrame:
    """One row ``epsg``: the zone at the centre of the total bounds of a lon/lat layer."""
    b = layer.agg(F.min(xmin).alias("x1"), F.min(ymin).alias("y1"), F.max(xmax).alias("x2"), F.max(ymax).alias("y2"))
    return b.select(utm_epsg((F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2).alias("epsg"))


def _zone(epsg: int) -> tuple[int, bool]:
    zone, south = epsg % 100, epsg // 100 == 327
    if epsg // 100 not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"unsupported CRS EPSG:{epsg}")
    return zone, south


def _direct(values: tuple, fn) -> Column:
    return fn(*values)


def _bound(values: tuple, fn) -> Column:
    """Evaluate the values once before ``fn`` uses them many times; for expressions inside array functions."""
    named = F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    return bind(named, lambda s: fn(*[s[f"v{i}"] for i in range(len(values))]))


def to_utm(lon: Column, lat: Column, epsg: int, share=_direct) -> Column:
    """``struct<x,y>`` of degrees."""
    zone, south = _zone(epsg)
    base = FALSE_NORTHING if south else 0.0
    lam, phi = F.radians(lon - (6.0 * zone - 183.0)), F.radians(lat)

    def sphere(lam, sin_phi):
        conformal = F.sinh(F.atanh(sin_phi) - _E * F.atanh(_E * sin_phi))
        return share((conformal, F.sin(lam), F.cos(lam)), plane)

    def plane(conformal, sin_lam, cos_lam):
        xi = F.atan2(conformal, cos_lam)
        eta = F.asinh(sin_lam / F.sqrt(conformal * conformal + cos_lam * cos_lam))
        return share((xi, eta), series)

    def series(xi, eta):
        east, north = eta, xi
        for j, a in enumerate(_FORWARD, start=1):
            east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
            north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        return vertex(SCALE * _RADIUS * east + FALSE_EASTING, SCALE * _RADIUS * north + base)

    return share((lam, F.sin(phi)), sphere)


def to_lonlat(x: Column, y: Column, epsg: int, share=_direct) -> Column:
    """``struct<x,y>`` (longitude, latitude) of an easting and northing."""
    zone, south = _zone(epsg)

    def series(xi, eta):
        xi0, eta0 = xi, eta
        for j, b in enumerate(_INVERSE, start=1):
            xi0 = xi0 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
            eta0 = eta0 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        return share((xi0, eta0), sphere)

    def sphere(xi, eta):
        lon = F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + (6.0 * zone - 183.0)
        psi = F.asinh(F.sin(xi) / F.sqrt(F.sinh(eta) * F.sinh(eta) + F.cos(xi) * F.cos(xi)))
        return share((lon, psi), ellipsoid)

    def ellipsoid(lon, psi):
        # fixed point from the conformal to the geodetic latitude; each round gains over two digits
        sin_phi = F.tanh(psi)
        for _ in range(6):
            sin_phi = F.tanh(psi + _E * F.atanh(_E * sin_phi))
        return vertex(lon, F.degrees(F.asin(sin_phi)))

    northing = (y - (FALSE_NORTHING if south else 0.0)) / (SCALE * _RADIUS)
    return share((northing, (x - FALSE_EASTING) / (SCALE * _RADIUS)), series)


def _move(x: Column, y: Column, source: int, target: int, share) -> Column:
    if source == target:
        return vertex(x, y)
    if source == 4326:
        return to_utm(x, y, target, share)
    if target == 4326:
        return to_lonlat(x, y, source, share)
    return bind(to_lonlat(x, y, source, share), lambda v: to_utm(v["x"], v["y"], target, share))


def reproject_xy(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """Coordinates between EPSG:4326 and UTM zones; any other CRS raises."""
    moved = _move(x, y, source, target, _direct)
    return moved["x"], moved["y"]


def reproject(df: DataFrame, source: int, target: int, x: str = "x", y: str = "y") -> DataFrame:
    """Reproject plain coordinate columns and the ``srid`` label."""
    nx, ny = reproject_xy(F.col(x), F.col(y), source, target)
    return df.withColumns({x: nx, y: ny, "srid": F.lit(target)})


def reproject_geom(geom: Column, source: int, target: int) -> Column:
    """Reproject every vertex of a geometry struct."""

    move = lambda v: _move(v["x"], v["y"], source, target, _bound)
    parts = F.transform(geom["parts"], lambda part: F.transform(part, lambda ring: F.transform(ring, move)))
    return F.struct(geom["type"].alias("type"), parts.alias("parts"))


def set_crs(df: DataFrame, epsg: int) -> DataFrame:
    """Set or override the CRS label without moving coordinates."""
    return df.withColumn("srid", F.lit(epsg))
