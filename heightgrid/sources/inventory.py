"""Inventory jobs over many files that read a few header or footer bytes of each."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heightgrid.functions.text import geo_footer_epsg


def _open(path: str):
    if "://" in path or path.startswith("file:"):
        system, inner = fs.FileSystem.from_uri(path)
    else:
        system, inner = fs.LocalFileSystem(), path
    return system.open_input_file(inner)


def _record_ids(handle) -> set[str]:
    """User ids of the variable length records, from the public LAS header layout."""
    head = handle.read_at(375, 0)
    if head[:4] != b"LASF":
        return set()
    minor = head[25]
    at, count = struct.unpack_from("<H", head, 94)[0], struct.unpack_from("<I", head, 100)[0]
    found = set()
    for _ in range(count):
        record = handle.read_at(54, at)
        found.add(record[2:18].split(b"\0")[0].decode("ascii", "replace").lower())
        at += 54 + struct.unpack_from("<H", record, 20)[0]
    if minor >= 4:
        at, count = struct.unpack_from("<QI", head, 235)
        for _ in range(count):
            record = handle.read_at(60, at)
            found.add(record[2:18].split(b"\0")[0].decode("ascii", "replace").lower())
            at += 60 + struct.unpack_from("<Q", record, 20)[0]
    return found


def _is_cloud_optimised(path: str) -> bool:
    try:
        with _open(path) as handle:
            return "copc" in _record_ids(handle)
    except Exception:  # any unreadable file counts as "no"
        return False


def cloud_optimised(paths: DataFrame, path: str = "path") -> DataFrame:
    """``(path, is_copc)`` for a table of point-file paths."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b[path], "is_copc": [_is_cloud_optimised(p) for p in b[path]]})

    return paths.select(path).mapInPandas(check, "path string, is_copc boolean")


def footer_crs(paths: DataFrame, path: str = "path") -> DataFrame:
    """``(path, epsg)`` from the ``geo`` footer entry of Parquet files; null where there is none."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for b in batches:
            texts = []
            for p in b[path]:
                with _open(p) as handle:
                    meta = pq.ParquetFile(handle).metadata.metadata or {}
                texts.append(meta[b"geo"].decode() if b"geo" in meta else None)
            yield pd.DataFrame({"path": b[path], "geo": texts})

    return paths.select(path).mapInPandas(read, "path string, geo string").select("path", geo_footer_epsg("geo").alias("epsg"))


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """Paths below a pattern without reading any content."""
    return spark.read.format("binaryFile").load(glob).select(F.col("path"), F.col("length"))
