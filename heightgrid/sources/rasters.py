"""Rasters as cell tables, and dense tile payloads for exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heightgrid.session import worker_partitions

STRIP = 1000  # rows of a tile that one task writes
PAYLOAD = 100  # cells per side of a dense payload, so that one row holds at most 10,000 values


def payload_to_cells(tiles: DataFrame, keys: list[str], value: str = "value", nodata: float | None = None) -> DataFrame:
    """Dense row-major payloads ``(.., col0, row0, width, values)`` to cells; nodata and NaN become absent rows."""
    cells = tiles.select(*keys, "col0", "row0", "width", F.posexplode("values").alias("_i", value)).select(
        *keys,
        (F.col("col0") + F.col("_i") % F.col("width")).alias("cx"),
        (F.col("row0") + F.floor(F.col("_i") / F.col("width"))).alias("cy"),
        value,
    )
    cells = cells.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return cells if nodata is None else cells.where(F.col(value) != nodata)


def cells_to_payload(cells: DataFrame, keys: list[str], value: str = "value", size: int = PAYLOAD) -> DataFrame:
    """Cells to dense row-major payloads of ``size`` x ``size``; absent cells are null.

    A payload is bounded by ``size``, whatever the size of the tile it is cut from. Rows are filled first and then
    stacked, so that a lookup goes over ``size`` entries, not over all cells of the payload.
    """
    origin = lambda c: (F.floor(F.col(c) / size) * size).cast("long")
    places = F.sequence(F.lit(0), F.lit(size - 1))
    group = [*keys, "col0", "row0"]
    at = cells.select(
        *keys, origin("cx").alias("col0"), origin("cy").alias("row0"), F.pmod("cx", F.lit(size)).cast("int").alias("_i"),
        F.pmod("cy", F.lit(size)).cast("int").alias("_j"), F.col(value).alias("_v"),
    )
    rows = at.groupBy(*group, "_j").agg(F.map_from_entries(F.collect_list(F.struct("_i", "_v"))).alias("_m"))
    rows = rows.select(*group, "_j", F.transform(places, lambda i: F.try_element_at("_m", i)).alias("_row"))
    stacked = rows.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("_j", "_row"))).alias("_m"))
    blank = F.transform(places, lambda i: F.lit(None).cast(cells.schema[value].dataType))
    dense = F.flatten(F.transform(places, lambda j: F.coalesce(F.try_element_at("_m", j), blank)))
    return stacked.select(*group, F.lit(size).alias("width"), dense.alias("values"))


def write_cells(cells: DataFrame, path: str, partition: str = "tile_id", mode: str = "append") -> None:
    """Cells in files in order of the tile, which row groups can be skipped by.

    The number of files follows the cluster, not the tiles: with a folder for each tile, writing, listing and reading
    cost some milliseconds a tile. Strips of a tile go to tasks of their own, so a tile may have any extent.
    """
    strip = F.floor(F.col("cy") / STRIP)
    dealt = cells.repartition(worker_partitions(cells.sparkSession), partition, strip)
    dealt.sortWithinPartitions(partition, "cy", "cx").write.mode(mode).parquet(path)


def read_cells(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
