"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heightgrid.session import checkpoint

#: Virtual nodes of each shard. The ring of 24 shards then has 3,072 arcs, which is all the driver ever sees.
NODES = 128
_HALF = 1 << 63


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """``(position, shard)`` of all virtual nodes in clockwise order; positions are signed 64-bit numbers."""
    at = lambda s, v: int.from_bytes(hashlib.md5(f"shard {s} node {v}".encode()).digest()[:8], "big") - _HALF
    return sorted((at(s, v), s) for s in range(shards) for v in range(nodes))


def allocate(counts: list[int], owners: list[int], capacity: list[int]) -> list[list[tuple[int, int]]]:
    """For each arc in clockwise order, ``(shard, rows)`` in the order its rows are dealt out.

    Every arc first gives its own shard what fits. What a full shard cannot take continues clockwise past the node and
    is offered to the next ones, so a row moves no further than it must and no shard exceeds its capacity.
    """
    room, n = list(capacity), len(counts)
    dealt: list[list[tuple[int, int]]] = []
    over = []
    for rows, shard in zip(counts, owners, strict=True):
        here = min(rows, room[shard])
        room[shard] -= here
        dealt.append([(shard, here)] if here else [])
        over.append(rows - here)
    carried: list[list[int]] = []  # [arc, rows] in flight, oldest first
    for turn in range(2 * n):
        i = turn % n
        kept = []
        for arc, rows in carried:
            here = min(rows, room[owners[i]])
            if here:
                room[owners[i]] -= here
                dealt[arc].append((owners[i], here))
            if rows > here:
                kept.append([arc, rows - here])
        carried = kept
        if turn < n and over[i]:
            carried.append([i, over[i]])
    return dealt


def assign(docs: DataFrame, shards: int = 24, nodes: int = NODES) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row, under the law ``rows``.

    A row's key is its text, then its id: the ring position is a hash of the text, so equal texts lie side by side and
    stay together but where a shard is full. Capacities are the row count divided by the shards, rounded up for the
    first ones, so shard sizes differ by one row at most. Rows are put in ring order by a range partitioning, which
    splits a large group of equal texts by its ids, and are numbered from the row counts of the partitions. Arc and
    shard then follow from the number alone.

    Null text: position of its own, size 8, ``text_crc32`` 0 as for an empty one. Null ids go first among equal texts.
    Repeated rows get slots of their own. An empty table gives an empty one; further columns are not read.
    """
    text = F.col("text").cast("string")
    raw = F.coalesce(text, F.lit("")).cast("binary")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.xxhash64(text, F.lit(17)).alias("place"),
    )
    keyed = keyed.withColumn("within", F.xxhash64("doc_id", F.lit(29)))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["place", "within", "doc_id", "size", "text_crc32"]
    lined = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("line", F.monotonically_increasing_id())
    lined = checkpoint(lined.select("*", F.shiftright("line", 33).alias("part")))
    per_part = lined.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    ahead = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = checkpoint(per_part.select("part", ahead.alias("ahead")))
    numbered = lined.join(F.broadcast(starts), "part").withColumn("number", F.col("ahead") + F.col("line").bitwiseAND((1 << 33) - 1))

    at = ring(shards, nodes)
    positions, owners = [p for p, _ in at], [s for _, s in at]
    # a key belongs to the first node at or after it; keys behind the last node go round to the first
    *counts, wrapped = _rows_per_arc(lined, positions)
    bounds = list(accumulate(counts))
    total = bounds[-1] + wrapped
    counts[0] += wrapped
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    pieces, used = [], [0] * shards
    for i, dealt in enumerate(allocate(counts, owners, capacity)):
        start = bounds[i - 1] if i else bounds[-1]
        for shard, rows in dealt:
            # the first arc begins behind the last node and goes round: its numbers run to the end, then from zero
            for low, high in _unwrapped(start, rows, total):
                pieces.append((low, high, shard, used[shard]))
                used[shard] += high - low
            start += rows
    pieces.sort()
    lows = [p[0] for p in pieces]
    table = docs.sparkSession.createDataFrame([(i, *p) for i, p in enumerate(pieces)], "piece int, low long, high long, shard int, base long")
    which = _search(F.col("number"), lows, "right") - 1
    placed = numbered.withColumn("piece", which).join(F.broadcast(table), "piece")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("base") + F.col("number") - F.col("low")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _unwrapped(start: int, rows: int, total: int) -> list[tuple[int, int]]:
    """The numbers ``start .. start + rows`` on a circle of ``total`` rows as plain intervals."""
    if not rows:
        return []
    start %= total
    end = start + rows
    return [(start, end)] if end <= total else [(start, total), (0, end - total)]


def _search(value: Column, bounds: list[int], side: str) -> Column:
    """How many of the sorted ``bounds`` lie below ``value`` (side left), or at or below it (right)."""
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def number_below(v: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, v.to_numpy(), side), dtype="int32")

    return number_below(value)


def _rows_per_arc(lined: DataFrame, positions: list[int]) -> list[int]:
    """Rows between each node and the one before it, and last the rows behind the last node."""
    arcs = lined.select(_search(F.col("place"), positions, "left").alias("arc")).groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()
    per_arc = {r.arc: r.n for r in arcs}
    return [per_arc.get(i, 0) for i in range(len(positions) + 1)]
