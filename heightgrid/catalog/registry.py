"""Registration of queries together with their SQL oracle."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from heightgrid.catalog.views import DUCK_VIEWS, Tables, needed_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(t: Tables)`` under ``name``; ``oracle`` may use the view names freely."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = complete(oracle)
        return fn

    return add


def complete(sql: str) -> str:
    """Prefix the SQL with the view definitions it needs as common table expressions."""
    names = needed_views(sql)
    if not names:
        return sql
    head = ",\n".join(f"{n} AS ({DUCK_VIEWS[n]})" for n in names)
    body = sql.strip()
    match = re.match(r"(?is)with\s+(recursive\s+)?", body)
    if match:
        recursive = "RECURSIVE " if match.group(1) else ""
        return f"WITH {recursive}{head},\n{body[match.end():]}"
    return f"WITH {head}\n{body}"
