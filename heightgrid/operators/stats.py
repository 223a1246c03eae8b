"""Statistics tables: describe, outliers, histogram, density, correlation, scores, box plots, fits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heightgrid.functions.text import band_name
from heightgrid.session import checkpoint, with_row

_PARTS = 1_000  # even parts a bracket is cut into by the sketch of a round
_SKETCH = 10_000  # rank error of the sketch: 1 / 10,000 of the bracket
_FEW = 20_000  # values of a bracket that are ranked one by one at the end


def _marks() -> Column:
    return F.percentile_approx("_v", [i / _PARTS for i in range(_PARTS + 1)], _SKETCH).alias("_s")


def _with_bracket(state: DataFrame) -> DataFrame:
    """Ends ``a``, ``b`` of the three parts of the sketch about the wanted rank."""
    at = F.floor(F.col("r") / F.col("m") * _PARTS)
    return state.withColumns({"a": F.get("_s", F.greatest(at - 1, F.lit(0))), "b": F.get("_s", F.least(at + 2, F.lit(_PARTS)))}).drop("_s")


def _meet(values: DataFrame, state: DataFrame, on: list[str]) -> DataFrame:
    return values.join(state, on) if on else values.crossJoin(F.broadcast(state))  # two rows for each quantile


def exact_quantiles(df: DataFrame, value: str, probs: list[float], keys: list[str] | None = None) -> DataFrame:
    """Exact interpolated quantiles as array ``q`` (plus ``n``) per group, without one task holding a whole group.

    Selection in rounds. Each wanted rank has a bracket of values, at first its whole group. A round sketches the
    bracket, takes three of its thousand parts, counts exactly what lies before, at, between and behind their ends, and
    goes on with the piece that holds the rank, whichever it is: a bad sketch costs a round, never a wrong value. The
    piece is written to the shared folder, so each round reads about 3 / 1,000 of the one before. Brackets of one
    value, or of few, are done; these few are ranked at the end. The column itself is written first, so that what comes
    before it runs once.

    Null values do not count; groups without values and an empty table give no row.
    """
    keys = keys or []
    named = checkpoint(df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v")))
    target = [*keys, "j"]
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = [F.struct(F.lit(2 * i + up).alias("j"), (F.ceil if up else F.floor)(pos).cast("long").alias("r")) for i, pos in enumerate(place) for up in (0, 1)]
    groups = named.groupBy(*keys).agg(
        _marks(), F.count("_v").alias("n"), F.count("_v").alias("m"), F.min("_v").alias("lo"), F.max("_v").alias("hi")
    )
    first = groups.where("n > 0").withColumn("_t", F.explode(F.array(*ranks))).select("*", "_t.*").drop("_t")
    state = checkpoint(_with_bracket(first))
    rest, on, done, pools = named, keys, [], []
    while True:
        wide = (F.col("m") > _FEW) & (F.col("lo") < F.col("hi"))
        closed = state.where(~wide).select(*target, "n", "r", "lo", "hi")
        ends = closed.where(F.col("lo") < F.col("hi")).select(*target, "lo", "hi")
        done.append(closed)
        few = ~wide & (F.col("lo") < F.col("hi"))
        left = state.agg(F.coalesce(F.bool_or(wide), F.lit(False)).alias("wide"), F.coalesce(F.bool_or(few), F.lit(False)).alias("few")).first()
        if left["few"]:
            pools.append(_meet(rest, ends, on).where(F.col("_v").between(F.col("lo"), F.col("hi"))).select(*target, "_v"))
        if not left["wide"]:
            break
        opened = state.where(wide)
        met = _meet(rest, opened.select(*target, "a", "b"), on)
        v, a, b = F.col("_v"), F.col("a"), F.col("b")
        piece = F.when(v < a, 0).when(v == a, 1).when(v < b, 2).when(v == b, 3).otherwise(4)
        pieces = met.groupBy(*target, piece.alias("_piece")).agg(F.count("_v").alias("m"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        upto = Window.partitionBy(*target).orderBy("_piece")  # at most five rows
        pieces = pieces.withColumn("_before", F.sum("m").over(upto) - F.col("m"))
        chosen = opened.select(*target, "n", "r").join(pieces, target)
        chosen = chosen.where((F.col("r") >= F.col("_before")) & (F.col("r") < F.col("_before") + F.col("m")))
        chosen = checkpoint(chosen.withColumn("r", F.col("r") - F.col("_before")).drop("_before", "_piece"))
        ends = chosen.where(F.col("lo") < F.col("hi")).select(*target, "lo", "hi")
        rest = checkpoint(_meet(rest, ends, on).where(F.col("_v").between(F.col("lo"), F.col("hi"))).select(*target, "_v"))
        on = target
        state = checkpoint(_with_bracket(chosen.join(rest.groupBy(*target).agg(_marks()), target, "left")))

    nothing = _meet(named, state.select(*target), keys).where(F.lit(False)).select(*target, "_v")
    closed, pool = (reduce(DataFrame.unionByName, parts) for parts in (done, pools or [nothing]))
    order = Window.partitionBy(*target).orderBy("_v")  # at most ``_FEW`` rows
    counted = pool.groupBy(*target, "_v").agg(F.count(F.lit(1)).alias("_c"))
    counted = counted.withColumn("_seen", F.sum("_c").over(order))
    hit = counted.join(closed.select(*target, "n", "r"), target).where(
        (F.col("r") < F.col("_seen")) & (F.col("r") >= F.col("_seen") - F.col("_c"))
    )
    tied = closed.where(F.col("lo") == F.col("hi")).select(*target, "n", F.col("lo").alias("_v"))
    found = hit.select(*target, "n", "_v").unionByName(tied)
    at = lambda j: F.max(F.when(F.col("j") == j, F.col("_v")))
    q = [at(2 * i) + (at(2 * i + 1) - at(2 * i)) * (pos - F.floor(pos)) for i, pos in enumerate(place)]
    return found.groupBy(*keys, "n").agg(F.array(*q).alias("q"))


def describe(df: DataFrame, value: str, digits: int = 6) -> DataFrame:
    """Count, mean, std, min, quartiles and max in one row; quartiles are exact."""
    basic = df.agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75])
    r = lambda c: F.round(c, digits)
    return with_row(basic, q.select("q")).select(
        "count", r("mean").alias("mean"), r("std").alias("std"), r("min").alias("min"), r(F.col("q")[0]).alias("p25"),
        r(F.col("q")[1]).alias("p50"), r(F.col("q")[2]).alias("p75"), r("max").alias("max"),
    )


def remove_outliers(df: DataFrame, value: str = "height", z_threshold: float = 2.5) -> DataFrame:
    """Rows whose z-score is strictly inside the threshold; with no spread nothing is kept, as 0/0 is no number."""
    m = df.agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))
    z = F.when(F.col("_std") > 0, (F.col(value) - F.col("_mean")) / F.col("_std"))
    return with_row(df, m).where((z > -z_threshold) & (z < z_threshold)).drop("_mean", "_std")


def drop_small(df: DataFrame, area: str = "area", n_std: float = 3.0) -> DataFrame:
    """Rows whose area is above mean - n_std * std."""
    m = df.agg((F.avg(area) - F.stddev_samp(area) * n_std).alias("_cut"))
    return with_row(df, m).where(F.col(area) > F.col("_cut")).drop("_cut")


def removed_rows(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows left after each named stage and rows the stage removed."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "rows")
        for i, (name, df) in enumerate(stages.items())
    ]
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    before = table.select((F.col("step") + 1).alias("step"), F.col("rows").alias("_before"))
    return table.join(before, "step", "left").select(
        "step", "stage", "rows", F.coalesce(F.col("_before") - F.col("rows"), F.lit(0)).alias("removed")
    )


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the range; the last one is closed. Only bins with rows are listed."""
    r = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(bins - 1)))
    binned = with_row(df.where(F.col(value).isNotNull()).select(value), r)
    return (
        binned.groupBy(F.coalesce(b, F.lit(0)).cast("int").alias("bin"), "_lo", "_hi")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin", (F.col("_lo") + F.col("bin") * width).alias("low"), (F.col("_lo") + (F.col("bin") + 1) * width).alias("high"), "n"
        )
    )


def kernel_density(df: DataFrame, value: str, points: int = 100, bins: int = 400) -> DataFrame:
    """Gaussian density of a column on an even grid (Scott bandwidth).

    The column is binned first, so the sum runs over at most ``bins`` weights for each of the ``points`` positions
    however many rows there are.
    """
    s = df.agg(
        F.count(value).alias("_n"), (F.stddev_samp(value) * F.pow(F.count(value).cast("double"), F.lit(-0.2))).alias("_h"),
        F.min(value).alias("_lo"), F.max(value).alias("_hi"),
    )
    weights = histogram(df, value, bins).agg(
        F.collect_list(F.struct(((F.col("low") + F.col("high")) / 2).alias("m"), F.col("n").alias("w"))).alias("_w")
    )
    grid = with_row(s, weights).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("i") / (points - 1)
    density = F.aggregate(
        F.transform("_w", lambda w: w["w"] * F.exp(-F.pow((F.col("x") - w["m"]) / F.col("_h"), F.lit(2.0)) / 2)),
        F.lit(0.0), lambda a, v: a + v,
    ) / (F.col("_n") * F.col("_h") * F.sqrt(2 * F.pi()))
    return grid.withColumn("x", x).select("i", "x", density.alias("density"))


def band_correlations(df: DataFrame, target: str, vector: str = "embedding", digits: int = 2) -> DataFrame:
    """Pearson correlation of a column with every element of an array column; null without spread.

    A row becomes one per element inside its task; what is shuffled are the sums of each band and task.
    """
    spread = df.select(F.col(target).cast("double").alias("_t"), F.posexplode(vector).alias("dim", "_v"))
    c = F.when(
        (F.stddev_pop("_v") > 0) & (F.stddev_pop("_t") > 0),
        F.covar_pop("_v", "_t") / (F.stddev_pop("_v") * F.stddev_pop("_t")),
    )
    return spread.groupBy("dim").agg(F.round(c, digits).alias("corr")).select("dim", band_name("dim").alias("band"), "corr")


def regression_scores(preds: DataFrame, keys: list[str], y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """R2, RMSE and MAE per group; the total sum of squares is taken about the group mean."""
    e = F.col(y) - F.col(p)
    sst = F.var_pop(y) * F.count(y)
    return preds.groupBy(*keys).agg(
        F.when(sst > 0, 1 - F.sum(e * e) / sst).alias("R2"), F.sqrt(F.avg(e * e)).alias("RMSE"), F.avg(F.abs(e)).alias("MAE")
    )


def number_folds(folds: DataFrame, fold: str = "folds") -> DataFrame:
    """Fold labels renumbered 1..k; the list of distinct folds is as short as the configured k."""
    return folds.select(fold).distinct().withColumn("fold_no", F.dense_rank().over(Window.orderBy(fold)))


def model_summary(results: DataFrame, metric: str) -> DataFrame:
    return results.groupBy("model").agg(F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"))


def best_model(results: DataFrame, metric: str = "RMSE") -> DataFrame:
    """One row: the model with the lowest mean error (highest for other metrics); ties go to the first name."""
    s = model_summary(results, metric)
    sign = 1.0 if metric.upper() in ("RMSE", "MAE") else -1.0
    top = F.min(F.struct((F.col("mean") * sign).alias("_k"), "model", "mean", "std"))
    return s.agg(top.alias("_t")).select("_t.model", "_t.mean", "_t.std")


def box_plot(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and the number and list of values outside them, per group."""
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], keys).select(
        *keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    iqr = F.col("q3") - F.col("q1")
    inside = F.col(value).between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr)
    return (
        df.select(*keys, value)
        .join(q, keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"), F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(1)).alias("n_outliers"),
        )
    )


def box_outliers(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The values outside the whiskers, one row each, so a group may have any number of them."""
    q = exact_quantiles(df, value, [0.25, 0.75], keys).select(*keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    inside = F.col(value).between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr)
    return df.select(*keys, value).join(q, keys).where(~inside).select(*keys, F.col(value).alias("outlier"))


def fit_line(preds: DataFrame, keys: list[str], y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Pooled R2 and RMSE with slope and intercept of predicted on true values."""
    e = F.col(y) - F.col(p)
    sst = F.var_pop(y) * F.count(y)
    return preds.groupBy(*keys).agg(
        F.when(sst > 0, 1 - F.sum(e * e) / sst).alias("R2"), F.sqrt(F.avg(e * e)).alias("RMSE"),
        F.regr_slope(p, y).alias("slope"), F.regr_intercept(p, y).alias("intercept"),
    )
