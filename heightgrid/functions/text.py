"""Small text and date helpers, all built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from heightgrid.settings import N_BANDS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def project_year(project) -> Column:
    """Year from the last four characters; null when they are not a number."""
    return F.right(_col(project), F.lit(4)).try_cast("int")


def file_stem(url) -> Column:
    """Base name up to its first dot."""
    return F.split_part(F.element_at(F.split(_col(url), "/"), -1), F.lit("."), F.lit(1))


def store_bucket(url) -> Column:
    """First label of the host name."""
    return F.split_part(F.parse_url(_col(url), F.lit("HOST")), F.lit("."), F.lit(1))


def store_key(url) -> Column:
    """Path without leading slashes."""
    return F.regexp_replace(F.parse_url(_col(url), F.lit("PATH")), "^/+", "")


def band_name(i) -> Column:
    """Zero-padded band name, ``A00`` upward."""
    return F.concat(F.lit("A"), F.lpad(_col(i).cast("string"), 2, "0"))


def band_names(n: int = N_BANDS) -> list[str]:
    return [f"A{i:02d}" for i in range(n)]


def with_extension(path, old: str, new: str) -> Column:
    return F.replace(_col(path), F.lit(old), F.lit(new))


def in_year(date, year: int) -> Column:
    """Half-open year span."""
    d = _col(date)
    return (d >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (d < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1)))


def catalogue_latest(body) -> Column:
    """The ``latest`` field of a catalogue document."""
    return F.get_json_object(_col(body), "$.latest")


def geo_footer_epsg(geo) -> Column:
    """The CRS code inside the ``geo`` footer document of a GeoParquet file."""
    return F.get_json_object(_col(geo), "$.columns.geometry.crs.id.code").cast("int")
