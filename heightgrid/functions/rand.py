"""Seeded randomness from ``md5(seed|key)``: the same for any partitioning and any rerun."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(seed, *keys) -> Column:
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def uniform(hash_col: Column, word: int = 0) -> Column:
    """Uniform number in [0, 1) from the ``word``-th group of eight hex digits (0..3)."""
    return F.conv(F.substring(hash_col, 1 + 8 * word, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_bucket(hash_col: Column, digits: int = 2) -> Column:
    """The leading hex digits as an integer; monotone in the hash."""
    return F.conv(F.substring(hash_col, 1, digits), 16, 10).cast("int")


def stable_id(*keys) -> Column:
    """Repeatable row id in place of a random one."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
