"""Session helpers: checkpoint folder, scratch paths, one-row joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "heightgrid", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "4m")  # small local files still feed all cores
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="heightgrid-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; all paths of one application lie in one folder that can go after it."""
    return f"{shared_dir(spark)}/heightgrid-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files; otherwise these lie on the disks until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def checkpoint(df: DataFrame, drop_shuffles: bool = False) -> DataFrame:
    """Cut the lineage through a table in the shared folder.

    A lost executor then costs a read. Unlike an RDD checkpoint the table is columnar and its size is known, so later
    joins prune columns and choose a broadcast by real size. With ``drop_shuffles`` the shuffles behind it go at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    with shuffles_dropped(spark) if drop_shuffles else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_partitions(spark: SparkSession) -> int:
    """Partitions for stages with Python workers: a fixed number, because merging small ones by bytes would idle cores."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row table (a global aggregate) to every row."""
    return df.crossJoin(F.broadcast(one_row))

