"""Numpy helpers over Arrow text columns: byte buffers, words of ASCII white space, rolling hashes.

A null text counts as empty. Texts are worked on in chunks of whole documents, so memory follows the chunk, or the
longest document where one is longer than a chunk.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 2_000_000
U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUES = (np.arange(256) & 0xC0) == 0x80

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * U(_BASE))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; kept for chunks, made anew for a longer document."""
    if len(_powers[0]) >= n:
        return _powers
    made = []
    for b in (_BASE, _BACK):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        made.append(np.multiply.accumulate(p))
    if n <= 2 * CHUNK_BYTES:
        _powers[:] = made
    return made


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and their ``n + 1`` offsets."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together stay within ``limit`` bytes; a longer text stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = b


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the number of the first word of each row (``n + 1`` entries)."""
    inside = ~SPACE[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    rows = offsets[:-1][offsets[:-1] < len(data)]
    begin[rows] = inside[rows]
    final = inside
    final[:-1] &= ~inside[1:] | begin[1:]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(final) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans from one running polynomial sum; equal bytes give equal hashes everywhere."""
    values = (_VALUE[LOWER] if lower else _VALUE)[data]
    power, back = _power_tables(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * power[: len(data)], out=running[1:])
    return mix((running[ends] - running[starts]) * back[starts])


def rolled(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` consecutive word hashes."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(m, n, np.uint64)
    for j in range(n):
        h = h * U(_BASE) + words[j : j + m]
    return mix(h)


def release() -> None:
    """Hand freed memory back to the system, as far as its allocator can.

    Python workers outlive a stage. What numpy and Arrow keep for later would add to what the next stage needs.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, with freed memory handed back before each further batch and after the last."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            release()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(steps(batches))
        release()

    return whole


def plain_documents(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` as long and ``text`` as string, with the named further columns; other columns are left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
