"""Grid algebra: cells, strata, meshes, pixel bounds, neighbourhoods, pyramids, resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heightgrid.functions.crs import reproject_xy
from heightgrid.operators.cover import cell_box, in_cell, polygon_cells, segment_meets_box
from heightgrid.session import with_row


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cell_key(x, y, res: float, x0: float = 0.0, y0: float = 0.0) -> tuple[Column, Column]:
    """Half-open grid cell of a point."""
    return F.floor((_col(x) - x0) / res), F.floor((_col(y) - y0) / res)


def digitize(value, edges) -> Column:
    """Number of edges strictly below the value (right-closed bins; 0 at or below the first edge)."""
    bins = F.array(*[F.lit(float(e)) for e in edges])
    return F.size(F.filter(bins, lambda e: e < _col(value))).cast("int")


def cut(value, edges, labels) -> Column:
    """Right-closed labelled bins; null outside and at the lowest edge."""
    v = _col(value)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for lo, hi, label in zip(edges[:-1], edges[1:], labels, strict=True):
        out = out.when((v > lo) & (v <= hi), F.lit(label))
    return out


def label_map(numbers, labels) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(int(n)) for n in numbers]), F.array(*[F.lit(x) for x in labels]))


def stratum_label(stratum, labels, offset: int = 0) -> Column:
    """Label of stratum 1..k; ``offset=1`` gives the label of the next interval instead."""
    numbers = [i + 1 - offset for i in range(len(labels))]
    return F.try_element_at(label_map(numbers, labels), _col(stratum))


def stratify(cells: DataFrame, value: str, edges, out: str = "strata") -> DataFrame:
    """Stratum of every cell; cells without data or at or below the first edge stay absent."""
    return cells.withColumn(out, digitize(value, edges)).where(F.col(out) > 0)


def mesh_grid(box: DataFrame, size_factor: int = 10) -> DataFrame:
    """``size_factor`` x ``size_factor`` boxes over each row's box, rows from north to south."""
    w = (F.col("xmax") - F.col("xmin")) / size_factor
    h = (F.col("ymax") - F.col("ymin")) / size_factor
    return step_grid(box.withColumns({"_w": w, "_h": h, "_nx": F.lit(size_factor), "_ny": F.lit(size_factor)}))


def mesh_by_step(box: DataFrame, x_step: float, y_step: float) -> DataFrame:
    """Boxes of a given step, from the upper left corner; the last row and column may stick out."""
    return step_grid(
        box.withColumns(
            {
                "_w": F.lit(float(x_step)), "_h": F.lit(float(y_step)),
                "_nx": F.ceil((F.col("xmax") - F.col("xmin")) / x_step).cast("int"),
                "_ny": F.ceil((F.col("ymax") - F.col("ymin")) / y_step).cast("int"),
            }
        )
    )


def step_grid(df: DataFrame) -> DataFrame:
    df = df.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("_ny") - 1)))
    df = df.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("_nx") - 1)))
    return df.withColumns(
        {
            "x1": F.col("xmin") + F.col("col") * F.col("_w"), "y1": F.col("ymax") - (F.col("row") + 1) * F.col("_h"),
            "x2": F.col("xmin") + (F.col("col") + 1) * F.col("_w"), "y2": F.col("ymax") - F.col("row") * F.col("_h"),
        }
    ).drop("_w", "_h", "_nx", "_ny")


def pixel_bounds(x, y, x1, y2, res: float, snap: str = "ceil") -> Column:
    """Bounds of the pixel a point snaps to on a grid with upper left corner ``(x1, y2)``."""
    x, y, x1, y2 = (_col(c) for c in (x, y, x1, y2))
    fn = {"ceil": F.ceil, "floor": F.floor}[snap]
    col, row = fn((x - x1) / res), fn((y2 - y) / res)
    return F.struct(
        (x1 + col * res).alias("xmin"), (y2 - (row + 1) * res).alias("ymin"),
        (x1 + (col + 1) * res).alias("xmax"), (y2 - row * res).alias("ymax"),
    )


def prediction_grid(layer: DataFrame, tile_size: float, geom: str | None = None) -> DataFrame:
    """Square blocks over the bounds of a layer that touch one of its members, with ids by position."""
    blocks = touched_blocks(layer, tile_size, tile_size, geom)
    return blocks.withColumn("id", F.col("brow") * F.col("_nx") + F.col("bcol")).drop("_nx", "_ny")


def touched_blocks(layer: DataFrame, width: float, height: float, geom: str | None = None) -> DataFrame:
    """Grid blocks (closed) over the total bounds that meet a member of the layer.

    Each member names the blocks its box touches (its polygon, when ``geom`` is given), so the grid is never
    enumerated as a whole.
    """
    w, h = float(width), float(height)
    b = layer.agg(
        F.min("xmin").alias("_x0"), F.min("ymin").alias("_y0"), F.max("xmax").alias("_x1"), F.max("ymax").alias("_y1")
    ).select(
        "_x0", "_y0",
        F.greatest(F.ceil((F.col("_x1") - F.col("_x0")) / w), F.lit(1)).cast("long").alias("_nx"),
        F.greatest(F.ceil((F.col("_y1") - F.col("_y0")) / h), F.lit(1)).cast("long").alias("_ny"),
    )

    def span(lo, hi, origin, step, n):
        first = F.greatest(F.ceil((F.col(lo) - F.col(origin)) / step) - 1, F.lit(0))
        last = F.least(F.floor((F.col(hi) - F.col(origin)) / step), F.col(n) - 1)
        return F.sequence(F.least(first, last), last)

    shape = ["lvl", "ix", "full", "ref", "edges"] if geom else []
    members = polygon_cells(layer, geom, []).withColumns(cell_box()) if geom else layer
    hit = with_row(members.select(*shape, "xmin", "ymin", "xmax", "ymax"), b)
    hit = hit.withColumn("bcol", F.explode(span("xmin", "xmax", "_x0", w, "_nx")))
    hit = hit.withColumn("brow", F.explode(span("ymin", "ymax", "_y0", h, "_ny")))
    if geom:
        # the part of the block in the cell touches the polygon if an edge meets it, or else if any place of it is inside
        low = {"x": F.greatest("xmin", F.col("_x0") + F.col("bcol") * w), "y": F.greatest("ymin", F.col("_y0") + F.col("brow") * h)}
        high = {"x": F.least("xmax", F.col("_x0") + (F.col("bcol") + 1) * w), "y": F.least("ymax", F.col("_y0") + (F.col("brow") + 1) * h)}
        edge = F.exists("edges", lambda e: segment_meets_box(e, low["x"], low["y"], high["x"], high["y"]))
        real = (low["x"] <= high["x"]) & (low["y"] <= high["y"])
        hit = hit.where(real & (edge | in_cell((low["x"] + high["x"]) / 2, (low["y"] + high["y"]) / 2)))
    hit = hit.select(
        "bcol", "brow",
        (F.col("_x0") + F.col("bcol") * w).alias("xmin"), (F.col("_y0") + F.col("brow") * h).alias("ymin"),
        (F.col("_x0") + (F.col("bcol") + 1) * w).alias("xmax"), (F.col("_y0") + (F.col("brow") + 1) * h).alias("ymax"),
        "_nx", "_ny",
    )
    return hit.distinct()


def _spread(cells: DataFrame, n: int, axis: str) -> DataFrame:
    shift = F.explode(F.sequence(F.lit(-n), F.lit(n)))
    return cells.withColumn("_d", shift).withColumn(axis, F.col(axis) + F.col("_d")).drop("_d")


def dilate(cells: DataFrame, n: int, keys: tuple = ()) -> DataFrame:
    """Cells within ``n`` cells (square neighbourhood), one axis at a time: 2(2n+1) copies, not (2n+1)^2."""
    cols = [*keys, "cx", "cy"]
    wide = _spread(cells.select(*cols), n, "cx").distinct()
    return _spread(wide, n, "cy").distinct()


def erode(cells: DataFrame, n: int, keys: tuple = ()) -> DataFrame:
    """Cells whose whole square neighbourhood is present, one axis at a time."""
    cols = [*keys, "cx", "cy"]
    full = F.count(F.lit(1)) == 2 * n + 1
    kept = cells.select(*cols).distinct()
    for axis in ("cx", "cy"):
        kept = _spread(kept, n, axis).groupBy(*cols).agg(full.alias("_full")).where("_full").drop("_full")
    return kept


def close_gaps(cells: DataFrame, distance: float, res: float, keys: tuple = ()) -> DataFrame:
    """Union outline with gaps up to twice ``distance`` closed: dilate, then erode."""
    n = max(1, int(-(-distance // res)))
    return erode(dilate(cells, n, keys), n, keys)


def pyramid(cells: DataFrame, value: str, levels: int, keys: tuple = (), how: str = "avg") -> DataFrame:
    """Overview levels 1..n, each from the level below it through mergeable sums.

    Level 1 is the only pass over the full raster; its cells are a quarter, and so on.
    ``nearest`` keeps the lower left source cell.
    """
    base = cells.select(
        *keys, F.col("cx").alias("_ox"), F.col("cy").alias("_oy"), F.col(value).cast("double").alias("_s"), F.lit(1).cast("long").alias("_n"),
        "cx", "cy",
    )
    out = None
    current = base
    for level in range(1, levels + 1):
        current = current.withColumns({"cx": F.floor(F.col("cx") / 2), "cy": F.floor(F.col("cy") / 2)}).groupBy(*keys, "cx", "cy")
        if how == "avg":
            current = current.agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
        else:
            low = F.struct("_oy", "_ox")
            current = current.agg(
                F.min_by("_s", low).alias("_s"), F.min(low).alias("_o"), F.lit(1).cast("long").alias("_n")
            ).select(*keys, "cx", "cy", "_s", "_n", F.col("_o._ox").alias("_ox"), F.col("_o._oy").alias("_oy"))
        part = current.select(
            *keys, F.lit(level).alias("level"), "cx", "cy", (F.col("_s") / F.col("_n")).alias(value)
        )
        out = part if out is None else out.unionByName(part)
    return out


def resample(cells: DataFrame, value_cols, res: float, srid: int, targets: DataFrame, target_res: float, target_srid: int):
    """Nearest-cell resampling: project each target cell centre back and look its source cell up."""
    x, y = reproject_xy((F.col("cx") + 0.5) * target_res, (F.col("cy") + 0.5) * target_res, target_srid, srid)
    back = targets.withColumns({"_sx": F.floor(x / res), "_sy": F.floor(y / res)})
    source = cells.select(F.col("cx").alias("_sx"), F.col("cy").alias("_sy"), *value_cols)
    return back.join(source, ["_sx", "_sy"]).drop("_sx", "_sy")
