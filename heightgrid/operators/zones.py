"""Connected zones of equal stratum on a cell table.

Labelling runs in two steps. Fixed windows of cells are labelled on their own, so a task never holds more than one
window. Zones that touch across a window border are then joined by a small graph of (label, label) edges, whose
smallest label is found with repeated joins and checkpoints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heightgrid.operators.grid import stratum_label
from heightgrid.session import checkpoint, worker_partitions

WINDOW = 64  # cells per side: a window holds at most 4,096 cells


def cell_code(cx, cy) -> Column:
    """One number per cell, ordered by column, then row."""
    cx, cy = (F.col(c) if isinstance(c, str) else c for c in (cx, cy))
    return (cx * F.lit(4294967296) + cy).cast("long")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each connected set of 0..n-1: hook larger roots to smaller ones, then shorten the chains."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        root[np.maximum(ra, rb)] = np.minimum(ra, rb)
        while not np.array_equal(root, root[root]):
            root = root[root]


def _label_windows(key: str):
    """Batches sorted by window and cell; all complete windows of a batch are labelled together."""

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        window = pdf[[key, "wx", "wy"]].diff().ne(0).any(axis=1).cumsum().to_numpy()
        i, j = (pdf["cx"] % WINDOW).to_numpy(), (pdf["cy"] % WINDOW).to_numpy()
        place, stratum = (window * WINDOW + i) * WINDOW + j, pdf["strata"].to_numpy()
        pairs = []
        for step, edge in ((1, j), (WINDOW, i)):
            at = np.minimum(np.searchsorted(place, place + step), len(place) - 1)
            joined = (place[at] == place + step) & (edge < WINDOW - 1) & (stratum[at] == stratum)
            pairs.append((np.flatnonzero(joined), at[joined]))
        a, b = (np.concatenate(side) for side in zip(*pairs, strict=True))
        root = _roots(len(pdf), a, b)
        return pdf[[key, "cx", "cy", "strata"]].assign(label=pdf["code"].to_numpy()[root])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            if len(pdf) == 0:
                continue
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            tail = (pdf[[key, "wx", "wy"]] == pdf[[key, "wx", "wy"]].iloc[-1]).all(axis=1)
            held = pdf[tail]
            if not tail.all():
                yield label(pdf[~tail])
        if held is not None:
            yield label(held)

    return run


def _window_labels(cells: DataFrame, key: str) -> DataFrame:
    """Window-local labels of distinct cells ``(key, cx, cy, strata)``; ``key`` is numeric."""
    place = [key, "wx", "wy"]
    rows = cells.select(
        key, F.col("cx").cast("long").alias("cx"), F.col("cy").cast("long").alias("cy"), F.col("strata").cast("int").alias("strata"),
        cell_code("cx", "cy").alias("code"), F.floor(F.col("cx") / WINDOW).alias("wx"), F.floor(F.col("cy") / WINDOW).alias("wy"),
    )
    parts = rows.repartition(worker_partitions(cells.sparkSession), *place).sortWithinPartitions(*place, "code")
    schema = f"{key} {dict(cells.dtypes)[key]}, cx long, cy long, strata int, label long"
    return parts.mapInPandas(_label_windows(key), schema)


def _border_edges(labelled: DataFrame, key: str) -> DataFrame:
    """Pairs of labels that touch across a window border with the same stratum."""
    out = None
    for axis in ("cx", "cy"):
        last = labelled.where(F.pmod(F.col(axis), F.lit(WINDOW)) == WINDOW - 1).select(
            key, "strata", *[(F.col(c) + (1 if c == axis else 0)).alias(c) for c in ("cx", "cy")], F.col("label").alias("a")
        )
        first = labelled.where(F.pmod(F.col(axis), F.lit(WINDOW)) == 0).select(
            key, "strata", "cx", "cy", F.col("label").alias("b")
        )
        pairs = last.join(first, [key, "strata", "cx", "cy"]).select(key, "a", "b")
        out = pairs if out is None else out.unionByName(pairs)
    return out.distinct()


def smallest_labels(edges: DataFrame, key: str) -> DataFrame:
    """``(key, label, root)``: the smallest label of each connected set of labels.

    Star contraction (Kiveris et al. 2014): link every neighbour to the smallest one, in turn upward and downward,
    until nothing changes. Rounds grow with the logarithm of the set size. Every round is checkpointed.
    """
    e = checkpoint(edges.where(F.col("a") != F.col("b")))
    state = None
    while True:
        # the table as a count and a 64-bit digest: it stays the same once all sets are stars
        digest = F.bit_xor(F.xxhash64(key, "a", "b"))
        before, state = state, tuple(e.agg(F.count(F.lit(1)), digest).first())
        if state[0] == 0 or state == before:
            break
        # large star: neighbours above a node move to the smallest label next to it
        both = e.select(key, "a", "b").unionByName(e.select(key, F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(key, "a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        down = both.join(low, [key, "a"]).where("b > a").select(key, F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        low = down.groupBy(key, "a").agg(F.min("b").alias("m"))
        moved = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))
        star = down.join(low, [key, "a"]).select(key, F.explode(moved).alias("e")).select(key, "e.a", "e.b")
        e = checkpoint(star.where("a <> b").distinct())
    return e.select(key, F.col("a").alias("label"), F.col("b").alias("root"))


def label_zones(cells: DataFrame, key: str = "tile_id") -> DataFrame:
    """``(key, cx, cy, strata, zone_id)``: 4-connected zones that do not cross a tile border.

    ``cells`` holds each cell once. The zone id is the smallest cell code of the zone.
    """
    labelled = checkpoint(_window_labels(cells, key))
    roots = smallest_labels(_border_edges(labelled, key), key)
    return labelled.join(roots, [key, "label"], "left").select(
        key, "cx", "cy", "strata", F.coalesce("root", "label").alias("zone_id")
    )


def zone_table(zones: DataFrame, res: float, key: str = "tile_id", labels=None, label_offset: int = 0) -> DataFrame:
    """One row per zone with its area, optionally labelled."""
    out = zones.groupBy(key, "strata", "zone_id").agg(
        F.count(F.lit(1)).alias("n_cells"), (F.count(F.lit(1)) * F.lit(float(res * res))).alias("area")
    )
    return out if labels is None else out.withColumn("label", stratum_label("strata", labels, label_offset))


def large_zones(zones: DataFrame, min_area: float, res: float, key: str = "tile_id") -> DataFrame:
    """Cells of the zones whose area is strictly above the limit."""
    keep = zone_table(zones, res, key).where(F.col("area") > min_area).select(key, "zone_id")
    return zones.join(keep, [key, "zone_id"], "left_semi")


def dissolve(cells: DataFrame, keys: list[str], res: float) -> DataFrame:
    """One row per key with the area and bounds of its cells; the cells stay the geometry."""
    return cells.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cells"), (F.count(F.lit(1)) * F.lit(float(res * res))).alias("area"),
        (F.min("cx") * res).alias("xmin"), (F.min("cy") * res).alias("ymin"),
        ((F.max("cx") + 1) * res).alias("xmax"), ((F.max("cy") + 1) * res).alias("ymax"),
    )
