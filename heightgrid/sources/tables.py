"""Vector tables: GeoParquet in and out, directories, hive-partitioned stores, CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heightgrid.functions.crs import set_crs
from heightgrid.functions.geometry import bbox
from heightgrid.functions.wkb import from_wkb, from_wkt, to_wkb
from heightgrid.session import checkpoint
from heightgrid.sources.footers import write_with_footer


def read_geoparquet(spark: SparkSession, path: str, srid: int | None = None, geometry: str = "geometry") -> DataFrame:
    """Parquet with a WKB column, decoded to ``geom``; other columns keep their pruning and pushdown."""
    df = spark.read.parquet(path).withColumn("geom", from_wkb(geometry)).drop(geometry)
    return df if srid is None else set_crs(df, srid)


def write_geoparquet(
    df: DataFrame, path: str, geometry: str = "geometry", mode: str = "overwrite", sort_cell: float | None = None, srid: int | None = None
):
    """``geom`` as WKB next to its bbox columns, so that readers can skip row groups by position.

    With ``sort_cell`` rows are ranged by coarse position first, which makes that skipping effective. With ``srid``
    each file carries the ``geo`` footer entry (encoding, CRS code, box columns, and the box of its own rows), which
    Spark's writer cannot add; see ``write_with_footer``.
    """
    box = bbox("geom")
    out = df.withColumn("bbox", box).withColumn(geometry, to_wkb("geom")).drop("geom")
    if sort_cell is not None:
        place = [F.floor(F.col("bbox.ymin") / sort_cell), F.floor(F.col("bbox.xmin") / sort_cell)]
        out = out.repartitionByRange(*place).sortWithinPartitions(*place)
    if srid is None:
        out.write.mode(mode).parquet(path)
    else:
        write_with_footer(out, path, geometry, srid, mode)


def read_directory(spark: SparkSession, path: str, srid: int = 4326, wkt: str | None = "wkt", out_path: str | None = None):
    """All Parquet files of a directory as one table; geometry rebuilt from its text column."""
    df = spark.read.option("mergeSchema", "false").parquet(path)
    if wkt and wkt in df.columns:
        df = df.withColumn("geom", from_wkt(wkt)).drop(wkt)
    df = set_crs(df, srid)
    if out_path is not None:
        write_geoparquet(df, out_path)
    return df


def select_water(df: DataFrame, bounds: tuple, mode: str = "overlap", kind: str = "geom_type") -> DataFrame:
    """Water polygons of a box from a table with box columns.

    ``corner`` asks only for the lower left corner to be in the box (ends included), ``overlap`` for the boxes to meet.
    Lines and points are left out. Plain comparisons on the box columns reach the Parquet scan.
    """
    x1, y1, x2, y2 = bounds
    c = F.col
    if mode == "corner":
        hit = c("xmin").between(x1, x2) & c("ymin").between(y1, y2)
    elif mode == "overlap":
        hit = (c("xmin") <= x2) & (c("xmax") >= x1) & (c("ymin") <= y2) & (c("ymax") >= y1)
    else:
        raise ValueError(f"unknown mode: {mode}")
    return df.where(hit & ~c(kind).isin("LINESTRING", "POINT"))


def read_hive(spark: SparkSession, root: str, columns: list[str], condition) -> DataFrame:
    """Partitioned store: partition filters prune folders, the rest is pushed to the scan."""
    return spark.read.parquet(root).where(condition).select(*columns)


def csv_to_parquet(spark: SparkSession, csv_path: str, schema: str, out_path: str, reject_path: str | None = None) -> DataFrame:
    """CSV with a declared schema to Parquet; missing files are skipped.

    Malformed rows go to ``reject_path`` (default: ``out_path`` with ``_rejects``) as ``file, record``, so what is left
    out can be counted and read. The text is parsed once. A damaged file ends the job instead of losing its rest.
    """
    parsed = checkpoint(
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_record")
        .option("ignoreMissingFiles", True)
        .schema(f"{schema}, _record string")
        .csv(csv_path)
        .withColumn("_file", F.col("_metadata.file_path"))
    )
    bad = F.col("_record").isNotNull()
    parsed.where(bad).select(F.col("_file").alias("file"), F.col("_record").alias("record")).write.mode("overwrite").parquet(
        reject_path or f"{out_path}_rejects"
    )
    parsed.where(~bad).drop("_record", "_file").write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def write_stats(stats: DataFrame, path: str) -> None:
    """A one-row statistics table as CSV with a header."""
    stats.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def site_rows(sites: DataFrame, name_col: str, name: str) -> DataFrame:
    """Rows of the named site; the column to look in is a parameter."""
    return sites.where(F.col(name_col) == name)
