"""Parquet files with a ``geo`` footer entry, written by tasks and put in place by one commit."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

_ROWS = 65_536  # rows of a row group


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a plain path or a URI."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def geo_entry(geometry: str, srid: int, box: list[float] | None) -> dict:
    """The footer document of a file: WKB in one column, its CRS code, the box columns and the box of all rows."""
    cover = {side: ["bbox", side] for side in ("xmin", "ymin", "xmax", "ymax")}
    column = {
        "encoding": "WKB", "geometry_types": [], "covering": {"bbox": cover},
        "crs": {"type": "GeodeticCRS" if srid == 4326 else "ProjectedCRS", "name": f"EPSG:{srid}", "id": {"authority": "EPSG", "code": srid}},
    }
    if box is not None:
        column["bbox"] = box
    return {"version": "1.1.0", "primary_column": geometry, "columns": {geometry: column}}


def _box(tables: list[pa.RecordBatch], before: list[float] | None) -> list[float] | None:
    import pyarrow.compute as pc

    ends = [before] if before else []
    for b in tables:
        box = b.column("bbox")
        low, high = ([f(pc.struct_field(box, side)).as_py() for side in sides] for f, sides in ((pc.min, ("xmin", "ymin")), (pc.max, ("xmax", "ymax"))))
        if None not in low + high:
            ends.append(low + high)
    return [f(e[k] for e in ends) for k, f in enumerate((min, min, max, max))] if ends else None


def write_with_footer(df: DataFrame, path: str, geometry: str, srid: int, mode: str = "overwrite") -> None:
    """Write ``df`` (with ``bbox`` and a WKB column) to Parquet files whose footer holds the ``geo`` document.

    Every attempt of a task writes a file of its own below ``_attempts``, which readers skip; the names of those that
    count come back with the finished tasks, one short row for each partition, and are renamed into place. Attempts
    that were lost or ran twice leave no trace. ``mode`` is ``overwrite``, ``append`` or ``error``.
    """
    if mode not in ("overwrite", "append", "error"):
        raise ValueError(f"unknown mode: {mode}")
    system, folder = locate(path)
    if mode == "error" and system.get_file_info(folder).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    run = uuid.uuid4().hex
    staged = f"{path.rstrip('/')}/_attempts/{run}"
    system.create_dir(f"{folder}/_attempts/{run}", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        target, inner = locate(staged)
        name, writer, sink, box, held, n = f"{uuid.uuid4().hex}.parquet", None, None, None, [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                schema, sink = b.schema, target.open_output_stream(f"{inner}/{name}")
                writer = pq.ParquetWriter(sink, schema, compression="snappy")
            box = _box([b], box)
            held.append(b)
            n += b.num_rows
            if n >= _ROWS:
                writer.write_table(pa.Table.from_batches(held, schema))
                held, n = [], 0
        if writer is not None:
            if held:
                writer.write_table(pa.Table.from_batches(held, schema))
            writer.add_key_value_metadata({"geo": json.dumps(geo_entry(geometry, srid, box))})
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"name": [name]})

    names = [r["name"] for r in df.mapInArrow(write, "name string").collect()]
    if not names:  # an empty table still has a schema
        import pyarrow.parquet as pq

        from pyspark.sql.pandas.types import to_arrow_schema

        empty = to_arrow_schema(df.schema).empty_table()
        meta = {"geo": json.dumps(geo_entry(geometry, srid, None))}
        names = ["empty.parquet"]
        pq.write_table(empty.replace_schema_metadata(meta), f"{folder}/_attempts/{run}/empty.parquet", filesystem=system)
    old = []
    if mode == "overwrite":
        old = [f.path for f in system.get_file_info(fs.FileSelector(folder)) if not f.base_name.startswith("_attempts")]
    for i, name in enumerate(sorted(names)):
        system.move(f"{folder}/_attempts/{run}/{name}", f"{folder}/part-{i:05d}-{run}.parquet")
    for file in old:
        system.delete_dir(file) if system.get_file_info(file).type == fs.FileType.Directory else system.delete_file(file)
    system.delete_dir(f"{folder}/_attempts")
