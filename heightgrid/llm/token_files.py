"""Token ids in seekable files: independent zstandard frames, an index of documents, a trailing seek table with checksums.

File format (little-endian): zstandard frames of 32-bit ids, each with a content checksum and holding whole documents; a
skippable frame with the index (ids of documents, whether they are null, their token counts, documents per frame); last a
skippable frame with the published seekable-format table, one entry per frame (compressed size, size, checksum) and a
footer. A reader takes the table from the file's end and decompresses only frames it needs.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from heightgrid.llm.bpe import byte_letters, gather
from heightgrid.llm.text import SPACE, batch_of, chunks, find_words, plain_documents, text_bytes
from heightgrid.session import scratch_path

#: Fixed values of the seekable format: skippable-frame magics, footer magic, descriptor bit for checksums.
_TABLE_MAGIC, _INDEX_MAGIC, _FOOTER_MAGIC, _WITH_CHECKSUM = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80
FRAME_IDS = 1 << 16
TEXT_BYTES = 16_000_000
WORDS_AT_ONCE = 2_000


def checksum(data: bytes) -> int:
    """The format's checksum: the low 32 bits of the 64-bit hash of the decompressed data."""
    return xxhash.xxh64(data).intdigest() & 0xFFFFFFFF


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or local path; works for every store that the Arrow library reaches."""
    return pafs.FileSystem.from_uri(path)


class FrameWriter:
    """Writes one file; documents come one by one, frames are closed once they hold ``frame_ids`` ids."""

    def __init__(self, stream, frame_ids: int = FRAME_IDS, level: int = 3):
        self.stream, self.frame_ids = stream, frame_ids
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.pending: list[bytes] = []
        self.held = 0
        self.entries: list[tuple[int, int, int]] = []
        self.per_frame: list[int] = []
        self.ids: list[int] = []
        self.nulls: list[bool] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, tokens: bytes) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.counts.append(len(tokens) // 4)
        self.pending.append(tokens)
        self.held += len(tokens) // 4
        if self.held >= self.frame_ids:
            self._close_frame()

    def _close_frame(self) -> None:
        if not self.pending:
            return
        data = b"".join(self.pending)
        packed = self.packer.compress(data)
        self.stream.write(packed)
        self.entries.append((len(packed), len(data), checksum(data)))
        self.per_frame.append(len(self.pending))
        self.pending, self.held = [], 0

    def finish(self) -> None:
        self._close_frame()
        arrays = (np.array(self.ids, "<i8"), np.array(self.nulls, "u1"), np.array(self.counts, "<u4"), np.array(self.per_frame, "<u4"))
        index = struct.pack("<QQ", len(self.ids), len(self.per_frame)) + self.packer.compress(b"".join(a.tobytes() for a in arrays))
        self.stream.write(struct.pack("<II", _INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), _WITH_CHECKSUM, _FOOTER_MAGIC)
        self.stream.write(struct.pack("<II", _TABLE_MAGIC, len(table)) + table)


class FrameReader:
    """Random access to a file: documents by number or by id; each frame that is read is checked against the table."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != _FOOTER_MAGIC or flags != _WITH_CHECKSUM:
            raise ValueError("not a seekable token file")
        start = end - 9 - 12 * n
        self.entries = [struct.unpack_from("<III", self._at(start, 12 * n), 12 * i) for i in range(n)] if n else []
        self.offsets = np.concatenate([[0], np.cumsum([e[0] for e in self.entries], dtype=np.int64)]).astype(np.int64)
        head = int(self.offsets[-1])
        magic, size = struct.unpack("<II", self._at(head, 8))
        if magic != _INDEX_MAGIC:
            raise ValueError("the index is missing")
        docs, frames = struct.unpack("<QQ", self._at(head + 8, 16))
        raw = zstandard.ZstdDecompressor().decompress(self._at(head + 24, size - 16))
        cuts = np.cumsum([0, 8 * docs, docs, 4 * docs, 4 * frames])
        self.ids, self.nulls, self.counts, per_frame = (np.frombuffer(raw[a:b], t) for a, b, t in zip(cuts[:-1], cuts[1:], ("<i8", "u1", "<u4", "<u4"), strict=True))
        self.first = np.concatenate([[0], np.cumsum(per_frame, dtype=np.int64)]).astype(np.int64)

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def frame(self, f: int) -> bytes:
        packed, size, check = self.entries[f]
        data = zstandard.ZstdDecompressor().decompress(self._at(int(self.offsets[f]), packed), max_output_size=size)
        if len(data) != size or checksum(data) != check:
            raise ValueError(f"frame {f} is damaged")
        return data

    def documents(self, frames: range | list[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        for f in range(len(self.entries)) if frames is None else frames:
            ids = np.frombuffer(self.frame(f), "<u4")
            at = 0
            for k in range(int(self.first[f]), int(self.first[f + 1])):
                n = int(self.counts[k])
                yield (None if self.nulls[k] else int(self.ids[k])), ids[at : at + n]
                at += n

    def document(self, doc_id: int) -> np.ndarray | None:
        """Ids of one document; only its frame is decompressed."""
        k = np.flatnonzero((self.ids == doc_id) & (self.nulls == 0))
        if not len(k):
            return None
        f = int(np.searchsorted(self.first, k[0], "right")) - 1
        before = int(self.counts[self.first[f] : k[0]].sum())
        return np.frombuffer(self.frame(f), "<u4")[before : before + int(self.counts[k[0]])]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class WordEncoder:
    """The library's ids of distinct words between ASCII white space.

    The vocabulary drops white space and splits at it, so the ids of a text are those of its words in turn. A word of
    Latin letters, with a full stop or comma at most behind them, is one letter run that the vocabulary only brings to
    lower case: distinct runs go straight to the library's model, many in one call. All other words go through the whole
    tokenizer. The offsets it returns tell which ids belong to which word.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.runs = Tokenizer(self.tokenizer.model)
        self.runs.pre_tokenizer = WhitespaceSplit()
        self.letter = str.maketrans({b: c for b, c in enumerate(byte_letters())})
        self.marks = {m: np.array(self.tokenizer.encode(m, add_special_tokens=False).ids, "<u4") for m in ".,"}

    def _many(self, tokenizer: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and their offsets; no text holds ASCII white space."""
        flat, to = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for a in range(0, len(texts), WORDS_AT_ONCE):
            some = texts[a : a + WORDS_AT_ONCE]
            got = tokenizer.encode(" ".join(some), add_special_tokens=False)
            starts = np.fromiter((s for s, _ in got.offsets), np.int64, len(got.ids))
            begins = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1)
            to.append(to[-1][-1] + np.searchsorted(starts, begins))
            flat.append(np.array(got.ids, "<u4"))
        return np.concatenate(flat), np.concatenate(to)

    def ids_of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and start and number of each word's."""
        runs: dict[str, int] = {}
        run_of, mark_of, odd = np.full(len(words), -1), np.zeros(len(words), np.int64), []
        marks = {"": 0, ".": 1, ",": 2}
        for i, w in enumerate(words):
            mark = w[-1] if w[-1] in ".," else ""
            run = w[:-1] if mark else w
            if run.isalpha() and (run.isascii() or (max(run) < "\u0250" and is_normalized("NFC", run) and "\u0130" not in run)):
                run = run.lower()
                run = run if run.isascii() else run.encode().decode("latin-1").translate(self.letter)
                run_of[i], mark_of[i] = runs.setdefault(run, len(runs)), marks[mark]
            else:
                odd.append(i)
        flat, to = self._many(self.runs, list(runs))
        own = np.flatnonzero(run_of >= 0)
        which = np.stack([run_of[own], len(runs) + mark_of[own]], axis=1).reshape(-1)
        tail = [np.zeros(0, "<u4"), self.marks["."], self.marks[","]]
        starts = np.concatenate([to[:-1], len(flat) + np.cumsum([0, len(tail[0]), len(tail[1])])])
        counts = np.concatenate([np.diff(to), [len(t) for t in tail]])
        ids, joined = gather(np.concatenate([flat, *tail]), starts, counts, which)
        rest, rest_to = self._many(self.tokenizer, [words[i] for i in odd])
        start, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        start[own], number[own] = joined[:-1][::2], joined[2::2] - joined[:-1][::2]
        start[odd], number[odd] = len(ids) + rest_to[:-1], np.diff(rest_to)
        return np.concatenate([ids, rest]), start, number

    def encode(self, column: pa.Array, end_id: int | None = None) -> Iterator[bytes]:
        """Packed ids of every row, with ``end_id`` behind them."""
        data, offsets = text_bytes(column)
        for a, b in chunks(offsets, TEXT_BYTES):
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            starts, ends, first = find_words(part, own)
            inside = np.ascontiguousarray(part[~SPACE[part]])
            at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(inside)]).dictionary_encode()
            words = coded.dictionary.cast(pa.large_string()).to_pylist()
            flat, start, number = self.ids_of_words(words)
            which = coded.indices.to_numpy(zero_copy_only=False)
            if end_id is not None:
                which = np.insert(which, first[1:], len(words))
                first = first + np.arange(len(first))
                start, number = np.append(start, len(flat)), np.append(number, 1)
                flat = np.append(flat, np.uint32(end_id))
            ids, to = gather(flat, start, number, which)
            packed, cuts = ids.astype("<u4").tobytes(), (4 * to[first]).tolist()
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                yield packed[i:j]


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2, frame_ids: int = FRAME_IDS) -> list[tuple[str, int, int]]:
    """Writes the ids of all documents in ascending id order; returns ``(path, documents, ids)`` of each file in order.

    A range partitioning by id gives each task one file, which it writes under a name of its own and renames at the end,
    so a repeated task leaves one whole file. Null ids go first; repeated ids lie side by side, ordered by text; null and
    empty texts are the end id alone; empty tables make empty files. One row per file reaches the driver.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = plain_documents(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    schema = pa.schema([("part", pa.int64()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, root = open_path(folder)
        fs.create_dir(root, recursive=True)
        encoder = WordEncoder(vocabulary)
        temporary = f"{root}/.writing-{uuid.uuid4().hex}"
        total = 0
        with fs.open_output_stream(temporary) as stream:
            writer = FrameWriter(stream, frame_ids)
            for batch in batches:
                for doc_id, packed in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1), end_id), strict=True):
                    writer.add(doc_id, packed)
                    total += len(packed) // 4
            writer.finish()
        name = f"part-{part:06d}.tokens"
        fs.move(temporary, f"{root}/{name}")
        yield batch_of({"part": [part], "path": [f"{folder}/{name}"], "documents": [len(writer.ids)], "ids": [total]}, schema)

    written = ordered.mapInArrow(run, "part long, path string, documents long, ids long").collect()
    return [(r.path, r.documents, r.ids) for r in sorted(written, key=lambda r: r.part)]


def read_token_files(spark, files: list[tuple[str, int, int]]) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files: ``start`` counts the ids of all before it."""
    rows, ahead = [], 0
    for path, _, ids in files:
        rows.append((path, ahead))
        ahead += ids
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, place = open_path(path)
                with fs.open_input_file(place) as source:
                    out: list[tuple] = []
                    for doc_id, ids in FrameReader(source).documents():
                        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(out) >= 10_000:
                            yield batch_of(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)
                            out = []
                    if out:
                        yield batch_of(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)

    listed = spark.createDataFrame(rows, "path string, start long").repartition(max(1, len(rows)))
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Write the table's ids into a new folder in the shared place and read every document back."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, scratch_path(spark, "tokens"), vocabulary, end_id))
