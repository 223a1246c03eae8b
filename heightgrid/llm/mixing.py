"""Mixing sources to target weights: whole copies for certain, the rest by Pareto order sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heightgrid.session import checkpoint

WEIGHTS = (3, 1, 2)
#: Cells a level of the search divides the rank range into: a rank has 48 bits, so three levels leave 2**12 ranks.
_LEVEL_BITS = 12
_RANK_BITS = 48


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target``: ``share`` of all words by weight, no source above ``most`` times its size.

    The excess of full sources is shared anew by weight until none is above: the sources are filled in the order of
    ``most * size / weight``, each against the level that the sources before it leave. Levels fall from the first open
    source on, so the greatest one is the right one. One row per source is windowed.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    named = sums.withColumn("w", weight).withColumn("cap", cap)
    left = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left_weight = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    levels = named.withColumn("level", left / left_weight).withColumn("full", F.col("level") * F.col("w") >= F.col("cap"))
    first_open = F.max(F.when(~F.col("full"), F.col("level"))).over(every)
    target = F.when(F.col("full"), F.col("cap")).otherwise(first_open * F.col("w"))
    return levels.select("source", "source_size", F.round(target, 6).alias("target"))


def uniform(seed: str, *keys: Column) -> Column:
    """A draw in (0, 1) from 48 bits of an md5 digest: the same for any partitioning and any rerun."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *keys)), 1, 12), 16, 10).cast("double")
    return (h + F.lit(0.5)) / F.lit(float(2**_RANK_BITS))


def text_digest(text: Column) -> Column:
    """Tells apart rows that repeat an id; a null text has the digest of an empty one."""
    return F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 16)


def pareto_rank(u: Column, inclusion_odds: Column) -> Column:
    """Random odds over inclusion odds, brought to 48 bits in the same order: small ranks are taken first."""
    q = u / (1 - u) / inclusion_odds
    return F.least(F.floor(q / (1 + q) * F.lit(float(2**_RANK_BITS))), F.lit(2**_RANK_BITS - 1)).cast("long")


def _narrowed(rows: DataFrame, shift: int) -> DataFrame:
    """Per source, the cell of ranks in which the running words pass the quota, and the words that lie before it.

    ``rows``: source, rank, size, quota, and ``before``, the words of earlier cells. Sums are taken per cell first; the
    window sees at most 4,096 cells of a source.
    """
    cells = rows.groupBy("source", "quota", "before", F.shiftright("rank", shift).alias("cell")).agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("cell")
    running = cells.withColumn("upto", F.col("before") + F.sum("words").over(order))
    passing = running.where(F.col("upto") >= F.col("quota")).withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return passing.select(F.col("source").alias("s"), F.col("cell").alias("passing"), (F.col("upto") - F.col("words")).alias("ahead"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` for every row of ``docs``.

    Every document of a source has ``floor(target / source_size)`` whole copies. The rest of the target is a fixed-size
    sample: documents in Pareto order, whose inclusion odds are those of the rest's share times the square root of the
    size, are taken until their words reach it; the last one only if that comes nearer. The place where the running
    words pass the quota is found by sums over ever smaller cells of ranks, so no source is sorted as a whole.

    Size counts words (null or empty text: 0, never taken). A null source is one source, the last. Ties of rank go by
    id, then text digest; repeated rows with equal ids and texts are one draw each in an arbitrary but equal order.
    An empty table gives an empty one; further columns are not read. Three windows see one row per source.
    """
    text = F.col("text").cast("string")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count("text").alias("size"),
        text_digest(text).alias("digest"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_text"),
    )
    sized = checkpoint(sized.select("*", uniform(seed, F.col("id_text"), F.col("digest")).alias("u")))
    targets = checkpoint(source_targets(sized, weights, share, most))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + F.lit(1e-9)).cast("long")
    rest = F.greatest(ratio - whole, F.lit(0.0))
    quotas = targets.select(
        F.col("source").alias("s"), "source_size", "target", whole.alias("whole"), (rest * F.col("source_size")).alias("quota"),
        F.when(rest > 1e-9, rest / (1 - rest)).alias("odds"),
    )
    same = F.col("source").eqNullSafe(F.col("s"))
    placed = sized.join(F.broadcast(quotas) if quotas.count() <= 100_000 else quotas, same).drop("s")
    rank = pareto_rank(F.col("u"), F.col("odds") * F.sqrt(F.col("size").cast("double")))
    drawn = placed.withColumn("rank", F.when((F.col("size") > 0) & F.col("odds").isNotNull(), rank))
    open_ = drawn.where(F.col("rank").isNotNull()).select("source", "doc_id", "digest", "size", "quota", "rank", F.lit(0.0).alias("before"))
    first = None
    for level in range(1, 4):
        shift = _RANK_BITS - level * _LEVEL_BITS
        cell = checkpoint(_narrowed(open_, shift))
        inside = open_.join(cell, same & (F.shiftright("rank", shift) == F.col("passing")))
        open_ = inside.select("source", "doc_id", "digest", "size", "quota", "rank", F.col("ahead").alias("before"))
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "digest")
    ended = open_.withColumn("upto", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    nearer = F.col("upto") - F.col("quota") <= F.col("quota") - (F.col("upto") - F.col("size"))
    chosen = (F.col("upto") <= F.col("quota")) | ((F.col("upto") - F.col("size") < F.col("quota")) & nearer)
    # all ranks of the last cell are few; the last taken one, with its ties, is the border
    last = ended.where(chosen).groupBy("source").agg(F.max(F.struct("rank", "doc_id", "digest")).alias("end"))
    floor = open_.groupBy("source").agg(F.min("rank").alias("low"))
    border = checkpoint(
        floor.join(last.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(F.col("source").alias("s"), "low", "end")
    )
    before_end = F.struct("rank", "doc_id", "digest") <= F.col("end")
    sampled = F.when(F.col("low").isNull(), F.lit(True)).when(F.col("end").isNull(), F.col("rank") < F.col("low")).otherwise(before_end)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.when(F.col("rank").isNotNull() & sampled, 1).otherwise(0)).otherwise(0).cast("long")
    result = drawn.join(F.broadcast(border) if border.count() <= 100_000 else border, same, "left")
    return result.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"), "digest")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them: none, once or repeated; columns stay as they are.

    The join is on id and text digest, so rows that repeat an id with other texts keep their own numbers of copies.
    """
    taken = mix(docs, **settings).groupBy("doc_id", "digest").agg(F.max("copies").alias("copies")).where("copies > 0")
    taken = taken.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("copies").alias("_copies"))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (text_digest(F.col("text").cast("string")) == F.col("_digest"))
    return docs.join(taken, on).withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)
