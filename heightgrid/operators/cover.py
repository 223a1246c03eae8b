"""Polygons as cells: a hierarchical cover with full cells and border cells.

A polygon starts as the at most four cells of its own extent. A cell that its border passes is cut into quarters, a few
times for every polygon, and as long as more than ``most`` edges cross the cell. A quarter without edges is full or
outside, and a full one is not cut further. So an interior is few large cells, and a border cell holds only the edges
that cross it.

Inside a border cell a place is tested with the edges of the cell alone, and exactly as ray casting over all edges would:
with ``x0`` the left side of the cell, every edge has the term ``passes to the right of the place`` XOR, for either
end, ``end is right of x0 and above the place``. Over a whole polygon the second parts cancel, because each vertex
ends two edges. The term of an edge that does not meet the cell is the same for all places of the cell; all those
together are one bit, ``ref``. Each comparison is one of ray casting itself or between stored numbers, so nothing
is rounded differently.

The cells are cut in numpy, all cells of many polygons at once; the tests at a place are Column expressions.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from heightgrid.functions.geometry import flat_edges
from heightgrid.session import worker_partitions

BOX = ("xmin", "ymin", "xmax", "ymax")
DEPTH, MOST, FEW = 3, 2, 4
#: Cells of about a millimetre are not cut further.
LEAST_LEVEL = -10
#: A cell counts as met by edges that pass it within this share of its size, and of a coordinate's last digits.
MARGIN = 1e-6
#: Edges of polygons that are cut together; a longer polygon stands alone.
TOGETHER = 100_000


def extent_level(xmin, ymin, xmax, ymax) -> Column:
    """Smallest power of two that is no smaller than the longer side."""
    side = F.greatest(F.col(xmax) - F.col(xmin), F.col(ymax) - F.col(ymin))
    return F.when(side <= 2.0**LEAST_LEVEL, F.lit(LEAST_LEVEL)).otherwise(F.ceil(F.log2(side))).cast("int")


def segment_meets_box(e: Column, x1: Column, y1: Column, x2: Column, y2: Column, margin: Column | float = 0.0) -> Column:
    """Whether an edge comes within ``margin`` of a closed box: their boxes meet, and the corners are not all on one side of its line."""
    mx, my, hx, hy = (x1 + x2) / 2, (y1 + y2) / 2, (x2 - x1) / 2 + margin, (y2 - y1) / 2 + margin
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    return (
        (F.greatest(e["x1"], e["x2"]) >= x1 - margin) & (F.least(e["x1"], e["x2"]) <= x2 + margin)
        & (F.greatest(e["y1"], e["y2"]) >= y1 - margin) & (F.least(e["y1"], e["y2"]) <= y2 + margin)
        & (F.abs(dx * (my - e["y1"]) - dy * (mx - e["x1"])) <= F.abs(dx) * hy + F.abs(dy) * hx)
    )


def _term(e: Column | dict[str, Column], x0: Column, px: Column, py: Column) -> Column:
    passes = ((e["y1"] > py) != (e["y2"] > py)) & (px < e["x1"] + e["s"] * (py - e["y1"]))
    ends = ((e["x1"] > x0) & (e["y1"] > py)) != ((e["x2"] > x0) & (e["y2"] > py))
    return passes != ends


def size_of(lvl: str = "lvl") -> Column:
    return F.pow(F.lit(2.0), F.col(lvl))


def in_cell(x, y) -> Column:
    """Whether a place within a cell (columns ``lvl, ix, full, ref, edges``) lies in the polygon."""
    px, py = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    x0 = F.col("ix") * size_of()
    few = reduce(operator.ne, [F.coalesce(_term(F.get("edges", F.lit(i)), x0, px, py), F.lit(False)) for i in range(FEW)])
    many = F.size(F.filter("edges", lambda e: _term(e, x0, px, py))) % 2 == 1
    odd = F.when(F.size("edges") <= FEW, few).otherwise(many)  # few edges need no lambda, so Spark compiles the test
    return F.col("full") | (odd != F.col("ref"))


_NUMBERS = [f"_{e}{c}" for e in "ab" for c in ("x1", "y1", "x2", "y2", "s")]


def laid_out(cells: DataFrame) -> DataFrame:
    """Cells of at most two edges with the edges' numbers as columns, for ``in_laid_out``, which Spark compiles.

    An edge that is not there is a place, which no ray passes; a full cell is one without edges whose places are inside.
    """
    edge = lambda i, c: F.coalesce(F.get("edges", F.lit(i))[c], F.lit(0.0))
    numbers = {f"_{e}{c}": edge(i, c) for i, e in enumerate("ab") for c in ("x1", "y1", "x2", "y2", "s")}
    few = cells.where(F.size("edges") <= 2)
    return few.withColumns({**numbers, "_x0": F.col("ix") * size_of(), "ref": F.col("ref") | F.col("full")}).drop("edges", "full")


def in_laid_out(x: str, y: str) -> Column:
    px, py = F.col(x), F.col(y)
    a, b = ({c: F.col(f"_{e}{c}") for c in ("x1", "y1", "x2", "y2", "s")} for e in "ab")
    return (_term(a, F.col("_x0"), px, py) != _term(b, F.col("_x0"), px, py)) != F.col("ref")


def cell_box() -> dict[str, Column]:
    s = size_of()
    return {"xmin": F.col("ix") * s, "ymin": F.col("iy") * s, "xmax": (F.col("ix") + 1) * s, "ymax": (F.col("iy") + 1) * s}


@dataclass
class _Cells:
    """Cells, and the edges that each of them holds as pairs of numbers in order of the cell."""

    row: np.ndarray
    lvl: np.ndarray
    ix: np.ndarray
    iy: np.ndarray
    ref: np.ndarray
    cell: np.ndarray
    edge: np.ndarray

    def only(self, wanted: np.ndarray) -> _Cells:
        number = np.cumsum(wanted) - 1
        pairs = wanted[self.cell]
        own = [c[wanted] for c in (self.row, self.lvl, self.ix, self.iy, self.ref)]
        return _Cells(*own, number[self.cell[pairs]], self.edge[pairs])

    def held(self) -> np.ndarray:
        return np.bincount(self.cell, minlength=len(self.row))

    def odd(self, edges: np.ndarray, px: np.ndarray, py: np.ndarray, ends: bool = True) -> np.ndarray:
        """Whether an odd number of the cell's edges have their term at a place of each cell (without ``ends``: pass to its right)."""
        x1, y1, x2, y2, run = edges[:, self.edge]
        px, py, x0 = px[self.cell], py[self.cell], (self.ix * np.ldexp(1.0, self.lvl))[self.cell]
        term = ((y1 > py) != (y2 > py)) & (px < x1 + run * (py - y1))
        if ends:
            term ^= ((x1 > x0) & (y1 > py)) ^ ((x2 > x0) & (y2 > py))
        return np.bincount(self.cell, term, len(self.row)) % 2 == 1

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        size = np.ldexp(1.0, self.lvl)
        return (self.ix + 0.5) * size, (self.iy + 0.5) * size

    def settled(self, edges: np.ndarray, inside: np.ndarray) -> tuple[_Cells, _Cells]:
        """Full cells and border cells, the latter with the edges that meet them; ``inside`` says where the centre lies."""
        size = np.ldexp(1.0, self.lvl)
        mx, my = self.centre()
        reach = size / 2 + size * MARGIN + np.maximum(np.maximum(np.abs(mx), np.abs(my)), 1.0) * 1e-12
        x1, y1, x2, y2, _ = edges[:, self.edge]
        mx, my, h = mx[self.cell], my[self.cell], reach[self.cell]
        dx, dy = x2 - x1, y2 - y1
        meets = (np.maximum(x1, x2) >= mx - h) & (np.minimum(x1, x2) <= mx + h) & (np.maximum(y1, y2) >= my - h) & (np.minimum(y1, y2) <= my + h)
        meets &= np.abs(dx * (my - y1) - dy * (mx - x1)) <= (np.abs(dx) + np.abs(dy)) * h
        local = _Cells(self.row, self.lvl, self.ix, self.iy, self.ref, self.cell[meets], self.edge[meets])
        border = local.held() > 0
        full, rest = local.only(~border & inside), local.only(border)
        rest.ref = rest.odd(edges, *rest.centre()) != inside[border]
        return full, rest

    def quarters(self, edges: np.ndarray) -> tuple[_Cells, _Cells]:
        n = len(self.row)
        four = lambda c: np.repeat(c, 4)
        part = np.tile(np.arange(4), n)
        order = np.argsort((4 * self.cell[:, None] + np.arange(4)).reshape(-1), kind="stable")
        cell, edge = (4 * self.cell[:, None] + np.arange(4)).reshape(-1)[order], four(self.edge)[order]
        made = _Cells(four(self.row), four(self.lvl) - 1, 2 * four(self.ix) + part % 2, 2 * four(self.iy) + part // 2, four(self.ref), cell, edge)
        parent = _Cells(made.row, four(self.lvl), four(self.ix), four(self.iy), made.ref, cell, edge)
        return made.settled(edges, parent.odd(edges, *made.centre()) != made.ref)


def _first_cells(box: np.ndarray, lvl: np.ndarray, offsets: np.ndarray) -> _Cells:
    size = np.ldexp(1.0, lvl)
    x1, y1, x2, y2 = (np.floor(c / size).astype(np.int64) for c in box)
    nx, ny = x2 - x1 + 1, y2 - y1 + 1
    row = np.repeat(np.arange(len(lvl)), nx * ny)
    at = np.arange(len(row)) - np.repeat(np.cumsum(nx * ny) - nx * ny, nx * ny)
    many = np.diff(offsets)[row]
    edge = np.repeat(offsets[row] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    return _Cells(row, lvl[row], x1[row] + at % nx[row], y1[row] + at // nx[row], np.zeros(len(row), bool), np.repeat(np.arange(len(row)), many), edge)


def cut_cells(edges: np.ndarray, offsets: np.ndarray, box: np.ndarray, lvl: np.ndarray, depth: int, most: int, least: float = 0.0) -> Iterator[tuple[_Cells, bool]]:
    """Cells of polygons, and whether they are full. ``edges``: five rows, those of polygon ``i`` from ``offsets[i]`` on."""
    cells = _first_cells(box, lvl, offsets)
    full, border = cells.settled(edges, cells.odd(edges, *cells.centre(), ends=False))
    yield full, True
    level = 0
    while len(border.row):
        again = (((level < depth) & (np.ldexp(1.0, border.lvl) > least)) | (border.held() > most)) & (border.lvl > LEAST_LEVEL)
        yield border.only(~again), False
        full, border = border.only(again).quarters(edges)
        yield full, True
        level += 1


def _slices(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    a, total = 0, np.concatenate([[0], np.cumsum(counts)])
    while a < len(counts):
        b = max(a + 1, int(np.searchsorted(total, total[a] + TOGETHER, "right")) - 1)
        yield a, b
        a = b


def polygon_cells(polygons: DataFrame, geom: str, keep: list[str], depth: int = DEPTH, most: int = MOST, least: float = 0.0) -> DataFrame:
    """``keep`` columns and ``lvl, ix, iy, full, ref, edges``: the cells of each polygon, which do not overlap.

    A cell of level ``lvl`` has sides of ``2 ** lvl`` and spans ``ix`` to ``ix + 1`` of them. ``polygons`` have the
    columns of ``BOX``. Polygons without edges, or null ones, have no cells. Border cells of sides up to ``least`` are cut
    only where they hold more than ``most`` edges.
    """
    flat = polygons.where(F.col(geom).isNotNull()).select(*keep, *[F.col(c).cast("double").alias(f"_{c}") for c in BOX], flat_edges(geom).alias("_all"))
    flat = flat.where(F.size("_all") > 0).withColumn("_lvl", extent_level(*(f"_{c}" for c in BOX)))
    made = {"lvl": IntegerType(), "ix": LongType(), "iy": LongType(), "full": BooleanType(), "ref": BooleanType(), "edges": flat.schema["_all"].dataType}
    schema = StructType([*flat.select(*keep).schema, *(StructField(name, kind) for name, kind in made.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("_all")
            counts = np.asarray(every.value_lengths()) if batch.num_rows else np.zeros(0, np.int64)
            for a, b in _slices(counts):
                some = batch.slice(a, b - a)
                structs = some.column("_all").flatten()
                edges = np.stack([np.asarray(structs.field(c)) for c in range(5)])
                offsets = np.concatenate([[0], np.cumsum(counts[a:b])])
                box = np.stack([np.asarray(some.column(f"_{c}")) for c in BOX])
                for cells, full in cut_cells(edges, offsets, box, np.asarray(some.column("_lvl")).astype(np.int64), depth, most, least):
                    if not len(cells.row):
                        continue
                    own = some.select(keep).take(pa.array(cells.row)) if keep else None
                    held = pa.array(np.concatenate([[0], np.cumsum(cells.held())]).astype(np.int32))
                    lists = pa.ListArray.from_arrays(held, pa.StructArray.from_arrays([pa.array(c) for c in edges[:, cells.edge]], ["x1", "y1", "x2", "y2", "s"]))
                    made = [pa.array(cells.lvl.astype(np.int32)), pa.array(cells.ix), pa.array(cells.iy), pa.array(np.full(len(cells.row), full)), pa.array(cells.ref), lists]
                    yield pa.RecordBatch.from_arrays([*(own.columns if own else []), *made], [*keep, "lvl", "ix", "iy", "full", "ref", "edges"])

    return flat.repartition(worker_partitions(polygons.sparkSession)).mapInArrow(run, schema)
