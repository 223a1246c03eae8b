"""Ground classification and height above ground."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heightgrid.operators.points import GROUND_CLASS
from heightgrid.session import checkpoint, worker_partitions

WINDOW_CELLS = 512  # cells along a side of a window of the ground filter, without its halo
LOW_OUTLIER_SLOPE = 5.0  # fixed value of the published method: a lone pit steeper than this is no ground


def _running(a: np.ndarray, r: int, axis: int, fn) -> np.ndarray:
    """Running minimum or maximum over 2r+1 cells by repeated doubling, where all of them are in the array: 2r cells fewer."""
    n, need = 1, 2 * r + 1
    cut = lambda b, lo, hi: b[lo:hi, :] if axis == 0 else b[:, lo:hi]
    while n < need:
        step = min(n, need - n)
        size = a.shape[axis]
        a = fn(cut(a, 0, size - step), cut(a, step, size))
        n += step
    return a


def _sliding(a: np.ndarray, r: int, axis: int, fn) -> np.ndarray:
    """The same for every cell of the array; what lies beyond takes no part."""
    width = [(r, r) if i == axis else (0, 0) for i in range(2)]
    return _running(np.pad(a, width, constant_values=np.inf if fn is np.minimum else -np.inf), r, axis, fn)


def _ring(a: np.ndarray) -> np.ndarray:
    """Minimum over 3 x 3 cells on an array one cell wider on each side; beyond ``a`` all is absent (inf)."""
    n, m = a.shape
    rows = np.full((n + 2, m), np.inf)
    for i in range(3):
        np.minimum(rows[i : i + n], a, out=rows[i : i + n])
    out = np.full((n + 2, m + 2), np.inf)
    for j in range(3):
        np.minimum(out[:, j : j + m], rows, out=out[:, j : j + m])
    return out


def _opening(eroded: np.ndarray, r: int) -> np.ndarray:
    """Opening with a square of 2r+1 cells from the running minimum, which is r cells wider on each side; absent cells take no part."""
    low = np.where(np.isinf(eroded), -np.inf, eroded)
    return _running(_running(low, r, 0, np.maximum), r, 1, np.maximum)


def _ground_surface(lowest: np.ndarray, steps: int, cell: float, slope: float, threshold: float, scalar: float):
    """Ground height and permitted distance of each cell of a dense grid; absent cells are inf.

    Openings with squares absorb each other, so each is taken from the lowest heights themselves: a cell depends on
    cells within ``_reach(steps)`` of it and on no others.
    """
    absent = np.isinf(lowest)
    with np.errstate(invalid="ignore"):
        upside_down = np.where(absent, np.inf, -lowest)
        outlier = ~absent & (upside_down - _opening(_ring(upside_down), 1) > LOW_OUTLIER_SLOPE * cell)
        base = np.where(outlier, np.inf, lowest)
        base = np.where(outlier, _opening(_ring(base), 1), base)
        base = np.where(np.isfinite(base), base, lowest)
        last, is_object, eroded = base, np.zeros(base.shape, dtype=bool), base
        for r in range(1, steps + 1):
            eroded = _ring(eroded)  # one ring of cells more each time
            opened = np.where(absent, np.inf, _opening(eroded, r))
            is_object |= (last - opened) > slope * r * cell
            last = opened
        dem = np.where(is_object, last, base)
        high = np.where(np.isinf(dem), -np.inf, dem)
        rise = [(_sliding(high, 1, a, np.maximum) - _sliding(dem, 1, a, np.minimum)) / (2 * cell) for a in (0, 1)]
    return dem, threshold + scalar * np.hypot(rise[0], rise[1])


def _reach(steps: int) -> int:
    """Cells that an outcome depends on in each direction: outlier pass (2 + 2), widest opening (2 * steps), slope (1)."""
    return 2 * steps + 5


def classify_ground(
    points: DataFrame, key: str = "tile_id", cell: float = 1.0, slope: float = 0.15, window: float = 18.0,
    threshold: float = 0.5, scalar: float = 1.25, span: int = WINDOW_CELLS,
) -> DataFrame:
    """Simple morphological ground filter (Pingel, Clarke and McBride 2013) with square windows; adds ``classification``.

    Points shrink map-side to one lowest height per cell. The grid is cut into windows of ``span`` x ``span`` cells,
    each with a halo as wide as the filter reaches, so a task's array is bounded whatever the tile's extent and
    the surface is the same for any ``span``. An array is cut to the box of its cells; what lies beyond is absent either way.
    Windows without a cell of their own are left out. Many windows come in a batch, sorted. The points themselves meet the
    surface in an equi-join, which drops points without a key.
    """
    gx, gy = F.floor(F.col("x") / cell).alias("_gx"), F.floor(F.col("y") / cell).alias("_gy")
    low = points.where(F.col(key).isNotNull()).groupBy(key, gx, gy).agg(F.min("z").alias("low"))
    steps = int(np.ceil(window / cell))
    halo = _reach(steps)
    by_window = [key, "_wx", "_wy"]

    def surface(pdf: pd.DataFrame, edges: np.ndarray) -> pd.DataFrame:
        """Surface at the own cells of the windows that begin at ``edges``."""
        low = pdf["low"].to_numpy(dtype=np.float64)
        gx, gy, wx, wy = (pdf[c].to_numpy() for c in ("_gx", "_gy", "_wx", "_wy"))
        i, j = gx - wx * span, gy - wy * span
        inner = (i >= 0) & (i < span) & (j >= 0) & (j < span)
        dem, limit = np.zeros(len(pdf)), np.zeros(len(pdf))
        for a, b in zip(edges, [*edges[1:], len(pdf)], strict=True):
            if not inner[a:b].any():
                continue
            at = i[a:b] - i[a:b].min(), j[a:b] - j[a:b].min()
            lowest = np.full((at[0].max() + 1, at[1].max() + 1), np.inf)
            lowest[at] = low[a:b]
            of_cell, allowed = _ground_surface(lowest, steps, cell, slope, threshold, scalar)
            dem[a:b], limit[a:b] = of_cell[at], allowed[at]
        return pdf[[key, "_gx", "_gy"]].assign(_dem=dem, _limit=limit)[inner]

    def surfaces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted batches in; only the last window of a batch waits for the next one."""
        held = None
        for pdf in batches:
            if len(pdf) == 0:
                continue
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            new = np.ones(len(pdf), bool)
            new[1:] = np.any([pdf[c].to_numpy()[1:] != pdf[c].to_numpy()[:-1] for c in by_window], axis=0)
            edges = np.flatnonzero(new)
            held = pdf.iloc[edges[-1] :]
            if len(edges) > 1:
                yield surface(pdf.iloc[: edges[-1]], edges[:-1])
        if held is not None:
            yield surface(held, np.zeros(1, np.int64))

    windows = lambda c: F.explode(F.sequence(F.floor((F.col(c) - halo) / span), F.floor((F.col(c) + halo) / span)))
    spread = low.withColumn("_wx", windows("_gx")).withColumn("_wy", windows("_gy"))
    schema = f"{key} {dict(points.dtypes)[key]}, _gx long, _gy long, _dem double, _limit double"
    parts = spread.repartition(worker_partitions(points.sparkSession), *by_window).sortWithinPartitions(*by_window)
    dem = parts.mapInPandas(surfaces, schema)
    tagged = points.withColumns({"_gx": F.floor(F.col("x") / cell), "_gy": F.floor(F.col("y") / cell)})
    is_ground = F.abs(F.col("z") - F.col("_dem")) <= F.col("_limit")
    return (
        tagged.join(dem, [key, "_gx", "_gy"])
        .withColumn("classification", F.when(is_ground, F.lit(GROUND_CLASS)).otherwise(F.lit(1)))
        .drop("_gx", "_gy", "_dem", "_limit")
    )


def _nearest(block: np.ndarray, x: np.ndarray, y: np.ndarray, z: np.ndarray):
    """Nearest ground place of the same block for every query; rows with a height are ground, others queries.

    Ground is ordered by block and x. Every query walks outward from its own x, to the right and to the left, until
    the distance in x alone is longer than the best found; all queries of all blocks take each step together.
    """
    ground = ~np.isnan(z)
    order = np.lexsort((x[ground], block[ground]))
    gb, gx, gy, gz = (c[ground][order] for c in (block, x, y, z))
    qb, qx, qy = block[~ground], x[~ground], y[~ground]
    span = (x.max() - x.min()) + 1.0
    start = np.searchsorted(gb * span + (gx - x.min()), qb * span + (qx - x.min()))
    best = np.full(len(qx), np.inf)
    best_z = np.full(len(qx), np.nan)
    for direction in (1, -1):
        at = start if direction == 1 else start - 1
        active = np.arange(len(qx))
        while len(active):
            ok = (at >= 0) & (at < len(gx))
            active, at = active[ok], at[ok]
            dx = gx[at] - qx[active]
            near = (gb[at] == qb[active]) & (dx * dx <= best[active])
            active, at, dx = active[near], at[near], dx[near]
            dy = gy[at] - qy[active]
            d2, height = dx * dx + dy * dy, gz[at]
            better = (d2 < best[active]) | ((d2 == best[active]) & (height < best_z[active]))
            hit = active[better]
            best[hit], best_z[hit] = d2[better], height[better]
            at = at + direction
    return best, best_z


def _search_blocks(key: str):
    """Arrow batches sorted by block in, answers out (null without ground in the block); only the last block of a batch waits for the next one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def answer(pdf: pd.DataFrame) -> pd.DataFrame:
            block = (pdf[[key, "_bx", "_by"]].diff().ne(0).any(axis=1)).cumsum().to_numpy(dtype=np.float64)
            x, y, z = (pdf[c].to_numpy(dtype=np.float64) for c in ("x", "y", "z"))
            d2, gz = _nearest(block, x, y, z)
            return pdf.loc[np.isnan(z), [key, "_bx", "_by", "x", "y"]].assign(d2=np.where(np.isfinite(d2), d2, np.nan), gz=gz)

        held = None
        for pdf in batches:
            if len(pdf) == 0:
                continue
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            tail = (pdf[[key, "_bx", "_by"]] == pdf[[key, "_bx", "_by"]].iloc[-1]).all(axis=1)
            held = pdf[tail]
            if not tail.all():
                yield answer(pdf[~tail])
        if held is not None:
            yield answer(held)

    return run


def _squares(blocks: DataFrame, key: str, width: int) -> DataFrame:
    """Boxes of what lies in squares of ``width`` blocks: ``key, sx, sy, x1, y1, x2, y2``."""
    at = [F.floor(F.col(c) / width).alias(n) for c, n in (("_bx", "sx"), ("_by", "sy"))]
    return blocks.groupBy(key, *at).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))


def _gap2(p: str, g: str) -> Column:
    """Squared distance of two boxes."""
    axis = lambda c: F.greatest(F.col(f"{g}{c}1") - F.col(f"{p}{c}2"), F.col(f"{p}{c}1") - F.col(f"{g}{c}2"), F.lit(0.0))
    return axis("x") * axis("x") + axis("y") * axis("y")


def _far2(p: str, g: str) -> Column:
    """Squared distance within which every place of one box surely has a place of the other, each side of which holds one."""
    axis = lambda c: F.greatest(F.col(f"{g}{c}2") - F.col(f"{p}{c}1"), F.col(f"{p}{c}2") - F.col(f"{g}{c}1"))
    return axis("x") * axis("x") + axis("y") * axis("y")


def block_pairs(places: DataFrame, ground: DataFrame, key: str) -> DataFrame:
    """``key, _bx, _by, gx, gy, gx1, gy1, gx2, gy2``: for each block of places the blocks of ground that may hold a nearest one.

    Both sides are trees of squares, each twice as wide as the ones below. From the top, a square of places meets the squares of
    ground that lie no further away than the best of them surely is; only those are opened. So how far ground is does not
    matter, only how many blocks are about equally near.
    """
    box = lambda df: df.groupBy(key, "_bx", "_by").agg(
        F.min("x").alias("x1"), F.min("y").alias("y1"), F.max("x").alias("x2"), F.max("y").alias("y2")
    )
    p, g = checkpoint(box(places)), checkpoint(box(ground))
    lows, highs = [F.min(c).alias(f"_0{c}") for c in ("_bx", "_by")], [F.max(c).alias(f"_1{c}") for c in ("_bx", "_by")]
    reach = checkpoint(p.select(key, "_bx", "_by").unionAll(g.select(key, "_bx", "_by")).groupBy(key).agg(*lows, *highs))
    widest = reach.agg(F.max(F.greatest(F.col("_1_bx") - F.col("_0_bx"), F.col("_1_by") - F.col("_0_by")))).first()[0] or 0
    from_corner = lambda df: df.join(reach, key).withColumns({c: F.col(c) - F.col(f"_0{c}") for c in ("_bx", "_by")})
    p, g = from_corner(p), from_corner(g)
    alive = None
    for level in range(int(widest).bit_length(), -1, -1):
        own = _squares(p, key, 1 << level).withColumnsRenamed({c: f"p{c}" for c in ("x1", "y1", "x2", "y2")}).withColumnsRenamed({"sx": "px", "sy": "py"})
        other = _squares(g, key, 1 << level).withColumnsRenamed({c: f"g{c}" for c in ("x1", "y1", "x2", "y2")}).withColumnsRenamed({"sx": "gx", "sy": "gy"})
        if alive is None:  # at the top a tile is one square
            met = own.join(other, key)
        else:
            up = lambda df, s: df.withColumns({f"_{s}x": F.floor(F.col(f"{s}x") / 2), f"_{s}y": F.floor(F.col(f"{s}y") / 2)})
            met = up(own, "p").join(alive, [key, "_px", "_py"]).join(up(other, "g"), [key, "_gx", "_gy"])
        square = Window.partitionBy(key, "px", "py")
        met = met.withColumn("_near", _gap2("p", "g")).withColumn("_sure", F.min(_far2("p", "g")).over(square)).where(F.col("_near") <= F.col("_sure"))
        if level:
            alive = checkpoint(met.select(key, *[F.col(c).alias(f"_{c}") for c in ("px", "py", "gx", "gy")]))
    index = {n: F.col(c) + F.col(f"_0{b}") for n, c, b in (("_bx", "px", "_bx"), ("_by", "py", "_by"), ("gx", "gx", "_bx"), ("gy", "gy", "_by"))}
    return met.join(reach, key).withColumns(index).select(key, "_bx", "_by", "gx", "gy", "gx1", "gy1", "gx2", "gy2")


def nearest_ground(places: DataFrame, ground: DataFrame, key: str = "tile_id", block: float = 25.0) -> DataFrame:
    """``(key, x, y, d2, gz)``: squared distance and height of the nearest ground point of the same tile.

    ``key`` is numeric; places and ground without key or coordinates have no answer and are none. Both sides hold each place once, so a block of ``block`` metres has a bounded number of places
    (stored coordinates are multiples of a fixed step). First every place looks inside its own block, which bounds its
    distance. Which other blocks may hold something nearer is found block by block; a place is handed over to those
    of them only that lie within its own bound; blocks beyond what it found at home go before its bound is taken.
    """
    bx, by = F.floor(F.col("x") / block), F.floor(F.col("y") / block)
    whole = lambda df: df.dropna(subset=[key, "x", "y"]).withColumns({"_bx": bx, "_by": by})
    g = checkpoint(whole(ground.select(key, "x", "y", "z")))
    schema = f"{key} {dict(places.dtypes)[key]}, _bx long, _by long, x double, y double, d2 double, gz double"

    def search(queries: DataFrame) -> DataFrame:
        both = queries.select(key, "_bx", "_by", "x", "y", F.lit(None).cast("double").alias("z")).unionByName(g)
        parts = both.repartition(worker_partitions(places.sparkSession), key, "_bx", "_by").sortWithinPartitions(key, "_bx", "_by")
        return parts.mapInPandas(_search_blocks(key), schema)

    q = checkpoint(whole(places.select(key, "x", "y")))
    first = checkpoint(search(q))
    met = first.drop("gz").join(block_pairs(q, g, key), [key, "_bx", "_by"])
    met = met.withColumns({"px1": F.col("x"), "py1": F.col("y"), "px2": F.col("x"), "py2": F.col("y")})
    met = met.withColumns({"_gap": _gap2("p", "g"), "_far": _far2("p", "g")})
    other = (F.col("_bx") != F.col("gx")) | (F.col("_by") != F.col("gy"))
    met = met.where(other & (F.col("d2").isNull() | (F.col("_gap") <= F.col("d2")))).select(key, "x", "y", "gx", "gy", "d2", "_gap", "_far")
    sure = F.least(F.col("d2"), F.min("_far").over(Window.partitionBy(key, "x", "y")))
    more = met.withColumn("_sure", sure).where(F.col("_gap") <= F.col("_sure"))
    more = more.select(key, "x", "y", F.col("gx").alias("_bx"), F.col("gy").alias("_by"))
    return (
        first.unionByName(search(more))
        .where(F.col("d2").isNotNull())
        .groupBy(key, "x", "y")
        .agg(F.min(F.struct("d2", "gz")).alias("_m"))
        .select(key, "x", "y", "_m.d2", "_m.gz")
    )


def height_above_ground(points: DataFrame, key: str = "tile_id", block: float = 25.0, out: str = "hag") -> DataFrame:
    """z minus z of the nearest ground point in the tile; null in a tile without ground."""
    ground = points.where(F.col("classification") == GROUND_CLASS).groupBy(key, "x", "y").agg(F.min("z").alias("z"))
    places = points.select(key, "x", "y").distinct()
    near = nearest_ground(places, ground, key, block)
    return points.join(near, [key, "x", "y"], "left").withColumn(out, F.col("z") - F.col("gz")).drop("d2", "gz")
