"""Planar geometry on a struct column: ``type`` plus ``parts`` (polygon > ring > vertex).

Everything here is a Column expression, so it runs inside Spark's own operators.
Rings are stored closed (first vertex repeated at the end). A point is one part with one ring of one vertex.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

VERTEX = "struct<x:double,y:double>"
GEOM = f"struct<type:string,parts:array<array<array<{VERTEX}>>>>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is evaluated once although ``fn`` may use it many times."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def vertex(x, y) -> Column:
    return F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))


def geometry(kind: str, parts: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), parts.alias("parts"))


def point_geom(x, y) -> Column:
    return geometry("POINT", F.array(F.array(F.array(vertex(x, y)))))


def polygon_from_xy(pairs: list[tuple]) -> Column:
    """A one-ring polygon from vertex expressions; the ring is closed here."""
    ring = F.array(*[vertex(x, y) for x, y in [*pairs, pairs[0]]])
    return geometry("POLYGON", F.array(F.array(ring)))


def box_geom(xmin="xmin", ymin="ymin", xmax="xmax", ymax="ymax") -> Column:
    """Envelope polygon, counter-clockwise from the lower left corner."""
    return polygon_from_xy([(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax)])


def geom_type(geom) -> Column:
    return _col(geom)["type"]


def is_empty(geom) -> Column:
    return F.size(vertices(geom)) == 0


def vertices(geom) -> Column:
    return F.flatten(F.flatten(_col(geom)["parts"]))


def bbox(geom) -> Column:
    """``struct<xmin,ymin,xmax,ymax>`` of all vertices."""
    return bind(
        vertices(geom),
        lambda v: F.struct(
            F.array_min(v["x"]).alias("xmin"),
            F.array_min(v["y"]).alias("ymin"),
            F.array_max(v["x"]).alias("xmax"),
            F.array_max(v["y"]).alias("ymax"),
        ),
    )


def _ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of one closed ring as ``struct<p,q>``."""
    n = F.size(ring)
    return F.zip_with(
        F.slice(ring, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(ring, 2, F.greatest(n - 1, F.lit(0))),
        lambda p, q: F.struct(p.alias("p"), q.alias("q")),
    )


def edges(geom) -> Column:
    return F.flatten(F.transform(F.flatten(_col(geom)["parts"]), _ring_edges))


def _total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def _ring_area(ring: Column) -> Column:
    """Unsigned area; coordinates are taken relative to the first vertex to keep digits."""
    o = F.element_at(ring, 1)
    terms = F.transform(
        _ring_edges(ring),
        lambda e: (e["p"]["x"] - o["x"]) * (e["q"]["y"] - o["y"]) - (e["q"]["x"] - o["x"]) * (e["p"]["y"] - o["y"]),
    )
    return F.abs(_total(terms)) / 2


def area(geom) -> Column:
    """Outer rings minus holes."""
    part_area = lambda part: 2 * _ring_area(F.element_at(part, 1)) - _total(F.transform(part, _ring_area))
    return _total(F.transform(_col(geom)["parts"], part_area))


def centroid(geom) -> Column:
    """Area centroid; for points (or zero area) the mean of the vertices."""

    def ring_moments(ring: Column) -> Column:
        o = F.element_at(ring, 1)

        def term(e):
            ax, ay = e["p"]["x"] - o["x"], e["p"]["y"] - o["y"]
            bx, by = e["q"]["x"] - o["x"], e["q"]["y"] - o["y"]
            cross = ax * by - bx * ay
            return F.struct(cross.alias("a"), ((ax + bx) * cross).alias("mx"), ((ay + by) * cross).alias("my"))

        return bind(
            F.transform(_ring_edges(ring), term),
            lambda t: bind(
                F.struct(_total(t["a"]).alias("a"), _total(t["mx"]).alias("mx"), _total(t["my"]).alias("my")),
                lambda s: F.struct(
                    (F.abs(s["a"]) / 2).alias("a"),
                    F.when(s["a"] != 0, o["x"] + s["mx"] / (3 * s["a"])).otherwise(o["x"]).alias("x"),
                    F.when(s["a"] != 0, o["y"] + s["my"] / (3 * s["a"])).otherwise(o["y"]).alias("y"),
                ),
            ),
        )

    def part_moments(part: Column) -> Column:
        return F.transform(
            F.transform(part, ring_moments),
            lambda m, i: F.struct(
                F.when(i == 0, m["a"]).otherwise(-m["a"]).alias("a"), m["x"].alias("x"), m["y"].alias("y")
            ),
        )

    moments = F.flatten(F.transform(_col(geom)["parts"], part_moments))

    def finish(m):
        total = _total(m["a"])
        return F.when(
            total > 0,
            vertex(
                _total(F.transform(m, lambda r: r["a"] * r["x"])) / total,
                _total(F.transform(m, lambda r: r["a"] * r["y"])) / total,
            ),
        )

    mean = bind(vertices(geom), lambda v: vertex(_total(v["x"]) / F.size(v), _total(v["y"]) / F.size(v)))
    return F.coalesce(bind(moments, finish), mean)


def flat_edges(geom) -> Column:
    """Edges as ``struct<x1,y1,x2,y2,s>`` with the run per unit of rise, for tests that are repeated per candidate.

    Work these out once per feature, before it meets its candidates in a join.
    """

    def flat(e):
        rise = e["q"]["y"] - e["p"]["y"]
        run = F.when(rise == 0, F.lit(0.0)).otherwise((e["q"]["x"] - e["p"]["x"]) / F.nullif(rise, F.lit(0.0)))
        return F.struct(
            e["p"]["x"].alias("x1"), e["p"]["y"].alias("y1"), e["q"]["x"].alias("x2"), e["q"]["y"].alias("y2"), run.alias("s")
        )

    return F.transform(edges(geom), flat)


def first_vertices(geom) -> Column:
    """One vertex of each part."""
    return F.transform(_col(geom)["parts"], lambda part: F.element_at(F.element_at(part, 1), 1))


def edges_contain(flat, x, y) -> Column:
    """Even-odd ray casting; left and lower borders count as inside, right and upper do not."""
    px, py = _col(x), _col(y)
    crosses = lambda e: ((e["y1"] > py) != (e["y2"] > py)) & (px < e["x1"] + e["s"] * (py - e["y1"]))
    return F.size(F.filter(_col(flat), crosses)) % 2 == 1


def contains_xy(geom, x, y) -> Column:
    """Point-in-polygon by ``edges_contain``."""
    return edges_contain(flat_edges(geom), x, y)


def on_border(geom, x, y) -> Column:
    px, py = _col(x), _col(y)

    def touches(e):
        return (
            ((e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"]) == 0)
            & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    return F.exists(flat_edges(geom), touches)


def covers_xy(geom, x, y) -> Column:
    """Closed point-in-polygon test: inside or on the border."""
    return contains_xy(geom, x, y) | on_border(geom, x, y)


def _side(e, x, y) -> Column:
    return F.signum((e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"]))


def _segments_meet(e: Column, f: Column) -> Column:
    apart = (
        (F.greatest(e["x1"], e["x2"]) < F.least(f["x1"], f["x2"]))
        | (F.greatest(f["x1"], f["x2"]) < F.least(e["x1"], e["x2"]))
        | (F.greatest(e["y1"], e["y2"]) < F.least(f["y1"], f["y2"]))
        | (F.greatest(f["y1"], f["y2"]) < F.least(e["y1"], e["y2"]))
    )
    return (
        ~apart
        & (_side(f, e["x1"], e["y1"]) * _side(f, e["x2"], e["y2"]) <= 0)
        & (_side(e, f["x1"], f["y1"]) * _side(e, f["x2"], f["y2"]) <= 0)
    )


def _segments_cross(e: Column, f: Column) -> Column:
    """Proper crossing in the interior of both segments."""
    return (_side(f, e["x1"], e["y1"]) * _side(f, e["x2"], e["y2"]) < 0) & (
        _side(e, f["x1"], f["y1"]) * _side(e, f["x2"], f["y2"]) < 0
    )


def edges_intersect(a_edges, a_first, b_edges, b_first) -> Column:
    """Closed polygon/polygon test: one holds a vertex of the other, or borders meet (the cheaper test comes first)."""
    ea, eb = _col(a_edges), _col(b_edges)
    return (
        F.exists(_col(a_first), lambda v: edges_contain(eb, v["x"], v["y"]))
        | F.exists(_col(b_first), lambda v: edges_contain(ea, v["x"], v["y"]))
        | F.exists(ea, lambda e: F.exists(eb, lambda f: _segments_meet(e, f)))
    )


def intersects(a, b) -> Column:
    """``edges_intersect`` of two geometry columns."""
    return edges_intersect(flat_edges(a), first_vertices(a), flat_edges(b), first_vertices(b))


def is_valid(geom) -> Column:
    """Every ring closed, with at least four vertices, some area, and no self-crossing."""

    def ring_ok(ring):
        return (
            (F.size(ring) >= 4)
            & (F.element_at(ring, 1) == F.element_at(ring, -1))
            & (_ring_area(ring) > 0)
            & bind(
                flat_edges(geometry("POLYGON", F.array(F.array(ring)))),
                lambda es: ~F.exists(es, lambda e: F.exists(es, lambda f: _segments_cross(e, f))),
            )
        )

    return F.coalesce(F.forall(F.flatten(_col(geom)["parts"]), ring_ok), F.lit(False)) & ~is_empty(geom)


def _clip_ring(ring: Column, axis: str, limit: Column, keep_above: bool) -> Column:
    """One half-plane clip of a closed ring (Sutherland and Hodgman 1974)."""
    inside = (lambda v: v[axis] >= limit) if keep_above else (lambda v: v[axis] <= limit)

    def cut(e):
        t = (limit - e["p"][axis]) / (e["q"][axis] - e["p"][axis])
        x = e["p"]["x"] + t * (e["q"]["x"] - e["p"]["x"])
        y = e["p"]["y"] + t * (e["q"]["y"] - e["p"]["y"])
        return vertex(limit, y) if axis == "x" else vertex(x, limit)

    def step(e):
        p_in, q_in = inside(e["p"]), inside(e["q"])
        return (
            F.when(p_in & q_in, F.array(e["q"]))
            .when(p_in, F.array(cut(e)))
            .when(q_in, F.array(cut(e), e["q"]))
            .otherwise(F.array().cast(f"array<{VERTEX}>"))
        )

    kept = F.flatten(F.transform(_ring_edges(ring), step))
    return bind(kept, lambda k: F.when(F.size(k) > 0, F.concat(F.slice(k, -1, 1), k)).otherwise(k))


def clip_to_box(geom, xmin="xmin", ymin="ymin", xmax="xmax", ymax="ymax") -> Column:
    """Intersection of a polygon with a rectangle; empty parts are dropped."""
    lo_x, lo_y, hi_x, hi_y = (_col(c) for c in (xmin, ymin, xmax, ymax))

    def ring_in_box(ring):
        r1 = _clip_ring(ring, "x", lo_x, True)
        return bind(
            r1,
            lambda a: bind(
                _clip_ring(a, "x", hi_x, False),
                lambda b: bind(_clip_ring(b, "y", lo_y, True), lambda c: _clip_ring(c, "y", hi_y, False)),
            ),
        )

    clipped = F.transform(
        _col(geom)["parts"], lambda part: F.filter(F.transform(part, ring_in_box), lambda r: F.size(r) >= 4)
    )
    return geometry("MULTIPOLYGON", F.filter(clipped, lambda part: F.size(part) > 0))
