"""Seeded stratified sampling and spatial folds.

Order inside a group is the order of ``md5(seed|key)``, so a sample does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heightgrid.functions.rand import hash_bucket, seeded_hash, uniform
from heightgrid.operators.grid import touched_blocks
from heightgrid.session import with_row


def hash_rank(df: DataFrame, keys: list[str], hash_col: str, out: str = "rn", digits: int = 2) -> DataFrame:
    """0-based rank by a uniform hash inside each group (or the whole table), for groups of any size.

    The hash prefix cuts a group into 16**digits even slices. Slices are ranked in parallel and shifted by the counts
    of the slices before them; a window never sees more than one slice or one row per slice.
    """
    cut = df.withColumn("_slice", hash_bucket(F.col(hash_col), digits))
    sizes = cut.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    upto = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shift = sizes.select(*keys, "_slice", (F.sum("_size").over(upto) - F.col("_size")).alias("_shift"))
    local = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(hash_col)) - 1
    return (
        cut.withColumn("_local", local)
        .join(shift, [*keys, "_slice"])
        .withColumn(out, F.col("_local") + F.col("_shift"))
        .drop("_slice", "_local", "_shift")
    )


def ordered_ids(df: DataFrame, key: str, out: str = "id", slices: int = 200) -> DataFrame:
    """Ids 0..n-1 in the order of a unique numeric key, without sorting the table in one task.

    Sketched quantiles of the key give even slices; ranks inside a slice are shifted by the rows before it.
    """
    probs = [i / slices for i in range(1, slices)]
    cuts = df.agg(F.percentile_approx(key, probs, 10 * slices).alias("_cuts"))
    # cut points are sorted, so the slice number is the count of cut points below the key
    lower = F.size(F.filter("_cuts", lambda c: c < F.col(key)))
    cut = with_row(df, cuts).withColumn("_slice", lower).drop("_cuts")
    sizes = cut.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    upto = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shift = sizes.select("_slice", (F.sum("_size").over(upto) - F.col("_size")).alias("_shift"))
    local = F.row_number().over(Window.partitionBy("_slice").orderBy(key)) - 1
    return (
        cut.withColumn("_local", local)
        .join(F.broadcast(shift), "_slice")  # at most ``slices`` rows
        .withColumn(out, F.col("_local") + F.col("_shift"))
        .drop("_slice", "_local", "_shift")
    )


def group_size_limit(df: DataFrame, keys: list[str], min_n: int) -> DataFrame:
    """One row ``n``: the smallest observed group size, at most ``min_n``."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    return sizes.agg(F.least(F.min("_size"), F.lit(min_n)).alias("n"))


def sample_per_group(df: DataFrame, keys: list[str], n: int, seed, id_cols: list[str]) -> DataFrame:
    """``n`` rows per group. The literal limit lets Spark cut each group map-side, before the shuffle."""
    h = seeded_hash(seed, *id_cols)
    w = Window.partitionBy(*keys).orderBy("_h", *id_cols)
    return df.withColumn("_h", h).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_h", "_rn")


def stratified_sample(df: DataFrame, keys: list[str], seed, id_cols: list[str], min_n: int = 10) -> DataFrame:
    """The same number of rows, ``min(smallest group, min_n)``, from each observed group."""
    h = seeded_hash(seed, *id_cols)
    w = Window.partitionBy(*keys).orderBy("_h", *id_cols)
    top = df.withColumn("_h", h).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= min_n)
    limit = group_size_limit(df, keys, min_n)
    return with_row(top, limit).where(F.col("_rn") <= F.col("n")).drop("_h", "_rn", "n")


def points_per_tile(sampled: DataFrame, n_samples: int) -> DataFrame:
    """One row: sampled tiles and points for each, ``int(n_samples / tiles)``."""
    return sampled.agg(F.count(F.lit(1)).alias("tiles")).select(
        "tiles", F.when(F.col("tiles") > 0, (F.lit(n_samples) / F.col("tiles")).cast("int")).alias("points_per_tile")
    )


def allocation(stratum, n, k: int, label_offset: int = 0) -> Column:
    """Points for stratum 1..k, growing with height: ``ceil(s / sum(1..k) * n)``."""
    s = (F.col(stratum) if isinstance(stratum, str) else stratum) + label_offset
    n = F.col(n) if isinstance(n, str) else F.lit(n)
    return F.ceil(s / F.lit(float(k * (k + 1) // 2)) * n).cast("int")


def random_points(cells: DataFrame, keys: list[str], counts: DataFrame, n_col: str, res: float, seed) -> DataFrame:
    """``n`` random points inside the area each group's cells cover, with replacement.

    Cells have equal area, so a draw picks a cell by uniform rank and then a uniform place inside it.
    """
    ranked = hash_rank(cells.withColumn("_h", seeded_hash(seed, *keys, "cx", "cy")), keys, "_h", "_rank").drop("_h")
    sizes = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cells"))
    draws = (
        sizes.join(counts.select(*keys, n_col), keys)
        .where(F.col(n_col) > 0)
        .withColumn("draw", F.explode(F.sequence(F.lit(1), F.col(n_col))))
        .withColumn("_u", seeded_hash(seed, *keys, "draw"))
        .withColumn("_rank", F.floor(uniform(F.col("_u"), 0) * F.col("_cells")))
    )
    return draws.join(ranked, [*keys, "_rank"]).select(
        *keys, "draw", "cx", "cy",
        ((F.col("cx") + uniform(F.col("_u"), 1)) * res).alias("x"), ((F.col("cy") + uniform(F.col("_u"), 2)) * res).alias("y"),
    )


def resample_groups(df: DataFrame, keys: list[str], n: int, seed, id_cols: list[str]) -> DataFrame:
    """``n`` rows per group drawn with replacement."""
    ranked = hash_rank(df.withColumn("_h", seeded_hash(seed, *id_cols)), keys, "_h", "_rank").drop("_h")
    draws = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumn("_rank", F.floor(uniform(seeded_hash(seed, *keys, "draw")) * F.col("_size")))
        .drop("_size")
    )
    return draws.join(ranked, [*keys, "_rank"]).drop("_rank")


def spatial_blocks(
    layer: DataFrame, width: float, height: float, n_folds: int, seed=420, method: str = "random",
    orientation: str = "tb-lr", geom: str | None = None,
) -> DataFrame:
    """Rectangular blocks over the total bounds that meet the layer, with a fold id 1..k.

    ``random`` deals the folds round in hash order; ``continuous`` deals them along the orientation.
    """
    blocks = touched_blocks(layer, width, height, geom)
    if method == "random":
        ranked = hash_rank(blocks.withColumn("_h", seeded_hash(seed, "bcol", "brow")), [], "_h", "_rn").drop("_h")
    elif method == "continuous":
        top = F.col("_ny") - 1 - F.col("brow")
        order = {
            "tb-lr": top * F.col("_nx") + F.col("bcol"),
            "bt-rl": F.col("brow") * F.col("_nx") + (F.col("_nx") - 1 - F.col("bcol")),
        }
        if orientation not in order:
            raise ValueError(f"unknown orientation: {orientation}")
        ranked = ordered_ids(blocks.withColumn("_pos", order[orientation]), "_pos", "_rn").drop("_pos")
    else:
        raise ValueError(f"unknown method: {method}")
    return ranked.withColumn("folds", (F.col("_rn") % n_folds + 1).cast("int")).drop("_rn", "_nx", "_ny")
