"""Byte-pair encoding and decoding with an index from each pair to all its places in a partition's new words."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from heightgrid.llm.text import CONTINUES, batch_of, chunks, plain_documents, text_bytes, tidy

#: Text worked on at a time; a longer text stands alone.
TEXT_BYTES = 4_000_000
#: Distinct pieces that are merged together.
PIECES_AT_ONCE = 250_000
#: White space in one byte, separators that some tables count as such included, and in several bytes.
WHITE = np.zeros(256, bool)
WHITE[[*range(9, 14), *range(28, 33)]] = True
WIDE_WHITE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: Fixed value: how the vocabulary splits texts into words, with white space named by its Unicode property.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_letters() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte: itself, or the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Merges:
    """A byte-level vocabulary file: ids of single bytes, rank and product of each pair, bytes of each id, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec.get("added_tokens", [])
        if model["type"] != "BPE" or spec.get("normalizer") or model.get("ignore_merges") or model.get("end_of_word_suffix"):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        vocab = model["vocab"]
        letter = byte_letters()
        back = {c: b for b, c in enumerate(letter)}
        self.byte_ids = np.array([vocab[c] for c in letter], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int64)
        made_at = np.full(max(vocab.values()) + 1, -1)
        made_at[self.product] = np.arange(len(pairs))
        # the order of ranks is the order of merging as long as no pair holds a token that only a later merge makes
        if len(np.unique(self.product)) < len(pairs) or (np.maximum(made_at[left], made_at[right]) >= np.arange(len(pairs))).any():
            raise ValueError(f"{path}: merges are not in the order in which their tokens arise")
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.left, self.right = left, right
        self.specials = {t["content"]: t["id"] for t in added}
        self.bytes_of = {i: bytes(back[c] for c in s) for s, i in vocab.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.specials.items()}
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.split = regex.compile(SPLIT)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 where the pair is not merged."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)


@lru_cache(maxsize=2)
def load_merges(path: str) -> Merges:
    return Merges(path)


def merge_spans(data: np.ndarray, word_ends: np.ndarray, cuts: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the bytes, and how many of them lie before each cut. No pair reaches over the end of a word.

    All words stand in one array of symbols; ``next`` and ``back`` link the symbols that are left.

    ``places`` holds, for each rank that occurs, the places of its pair. Ranks are taken in ascending order from a heap;
    all places of a rank merge at once, and only the pairs beside them are looked up and added to the index.
    """
    n = len(data)
    symbol = merges.byte_ids[data]
    next_ = np.arange(1, n + 1, dtype=np.int32)
    next_[word_ends - 1] = -1
    back = np.arange(-1, n - 1, dtype=np.int32)
    back[np.append(0, word_ends[:-1])[: len(word_ends)]] = -1
    places: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def index(at: np.ndarray) -> None:
        ranks = merges.rank_of(symbol[at], symbol[next_[at]])
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        if not len(at):
            return
        if len(at) < 64:
            for p, r in zip(at, ranks.tolist(), strict=True):
                if r not in places:
                    places[r] = []
                    heapq.heappush(heap, r)
                places[r].append(at[at == p] if len(at) == 1 else np.array([p]))
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for r, some in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
            if r not in places:
                places[r] = []
                heapq.heappush(heap, r)
            places[r].append(some)

    index(np.flatnonzero(next_ >= 0))
    while heap:
        r = heapq.heappop(heap)
        found = places.pop(r)
        at = _distinct(np.concatenate(found)) if len(found) > 1 else found[0]
        at = at[(symbol[at] == merges.left[r]) & (symbol[next_[at]] == merges.right[r]) & (next_[at] >= 0)]
        if not len(at):
            continue
        if len(at) > 1:
            at = _apart(at if len(found) > 1 else np.sort(at), next_)
        gone = next_[at]
        symbol[at] = merges.product[r]
        symbol[gone] = -1
        after = next_[gone]
        next_[at] = after
        next_[gone] = -1
        some = after >= 0
        back[after[some]] = at[some]
        before = back[at]
        index(_distinct(np.concatenate([at[some], before[before >= 0]])))
    kept = symbol >= 0
    return symbol[kept].astype(np.int32), np.concatenate([[0], np.cumsum(kept)])[cuts]


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def _apart(at: np.ndarray, next_: np.ndarray) -> np.ndarray:
    """Of places whose pairs overlap in a chain (``x x x``), every other one from the left."""
    linked = np.zeros(len(at), bool)
    linked[1:] = next_[at[:-1]] == at[1:]
    if not linked.any():
        return at
    number = np.arange(len(at))
    start = np.maximum.accumulate(np.where(linked, 0, number))
    return at[(number - start) % 2 == 0]


def _beside_white_space(data: np.ndarray) -> np.ndarray:
    """Bytes of white space, wide characters included."""
    white = WHITE[data]
    if (data >= 0xE1).any() or (data == 0xC2).any():
        for m in WIDE_WHITE.finditer(data.tobytes()):
            white[m.start() : m.end()] = True
    return white


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of pieces and the number of each row's first piece (``n + 1`` entries).

    A single space between two characters that are no white space always begins a new word, so texts are cut there.
    """
    white = _beside_white_space(data)
    begin = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        begin[1:-2] = (data[1:-1] == 32) & ~white[:-2] & ~white[2:]
    begin[offsets] = True
    begin[-1] = True
    at = np.flatnonzero(begin)
    return at, np.searchsorted(at, offsets)


def _distinct_pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray]:
    column = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def _buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``flat[starts[k] : starts[k] + counts[k]]`` for all ``k`` in ``which`` one behind the other, and their offsets."""
    size = counts[which]
    to = np.concatenate([[0], np.cumsum(size)])
    return flat[np.repeat(starts[which] - to[:-1], size) + np.arange(to[-1])], to


def split_words(piece: str, merges: Merges) -> list[str]:
    """Words of a piece; a special token stands alone, so that no word holds one."""
    out, done = [], 0
    for found in merges.special_pattern.finditer(piece) if merges.special_pattern else ():
        out += merges.split.findall(piece[done : found.start()])
        out.append(found[0])
        done = found.end()
    return out + merges.split.findall(piece[done:])


def _odd_pieces(pieces: list[bytes], merges: Merges) -> list[np.ndarray]:
    """Ids of pieces that begin a row, end in white space or hold a special token: split one by one, merged together."""
    split = [split_words(p.decode(), merges) for p in pieces]
    words = [w for w in dict.fromkeys(w for ws in split for w in ws) if w not in merges.specials]
    raw = [w.encode() for w in words]
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
    ids, to = merge_spans(np.frombuffer(b"".join(raw), np.uint8), ends, ends, merges) if raw else (np.zeros(0, np.int32), ends)
    known = {w: np.array([i], np.int32) for w, i in merges.specials.items()}
    known.update(zip(words, np.split(ids, to[:-1]) if len(to) else [], strict=True))
    return [np.concatenate([known[w] for w in ws]) if ws else np.zeros(0, np.int32) for ws in split]


def encode_rows(data: np.ndarray, offsets: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one behind the other, and their ``n + 1`` offsets.

    Every distinct piece is split once and every distinct word merged once, all together, so that their places share one index.
    """
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    at, first = cut_pieces(data, offsets)
    which, pieces = _distinct_pieces(data, at)
    raw, own = _buffer_of(pieces)
    odd = (raw[own[:-1]] != 32) | WHITE[raw[own[1:] - 1]] | (raw[own[1:] - 1] >= 0x80) & _ends_wide(raw, own)
    whole = raw.tobytes()
    for s in merges.specials:
        place = whole.find(s.encode())
        while place >= 0:
            odd[np.searchsorted(own, place, "right") - 1] = True
            place = whole.find(s.encode(), place + 1)
    counts, starts = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    flat, filled = [], 0
    plain = np.flatnonzero(~odd)
    for a in range(0, len(plain), PIECES_AT_ONCE):
        some = plain[a : a + PIECES_AT_ONCE]
        joined, cuts = _buffer_of(pieces.take(pa.array(some)))
        # byte places of characters, to turn lengths in characters into places in the buffer
        letters = np.append(np.flatnonzero(~CONTINUES[joined]), len(joined))
        words = merges.split.findall(joined.tobytes().decode())
        ends = letters[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
        each, distinct = _distinct_pieces(joined, np.append(0, ends))
        word_bytes, word_at = _buffer_of(distinct)
        ids, to = merge_spans(word_bytes, word_at[1:], word_at, merges)
        ids, to = gather(ids, to[:-1], np.diff(to), each)
        to = to[np.searchsorted(np.append(0, ends), cuts)]
        starts[some], counts[some] = filled + to[:-1], np.diff(to)
        flat.append(ids)
        filled += len(ids)
    rest = np.flatnonzero(odd)
    for k, ids in zip(rest.tolist(), _odd_pieces(pieces.take(pa.array(rest)).to_pylist(), merges), strict=True):
        starts[k], counts[k] = filled, len(ids)
        flat.append(ids)
        filled += len(ids)
    ids, to = gather(np.concatenate(flat), starts, counts, which)
    return ids, to[first]


def _ends_wide(raw: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Pieces that end in a wide white-space character."""
    return _beside_white_space(raw)[own[1:] - 1]


def _encoded(column: pa.Array, merges: Merges) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, number of rows, ids and offsets of each run of rows that is worked on at a time."""
    data, offsets = text_bytes(column)
    for a, b in chunks(offsets, TEXT_BYTES):
        yield a, b - a, *encode_rows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], merges)


def decode(ids: list[int], merges: Merges) -> str:
    """The text of ids, special tokens included; bytes that are no UTF-8 become the replacement character."""
    return b"".join(map(merges.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; null or empty text: no ids. See :func:`round_trip` for the other cases."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load_merges(vocabulary)
        for batch in batches:
            for a, n, ids, to in _encoded(batch.column(1), merges):
                lists = pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(ids, pa.int32()))
                yield batch_of({"doc_id": batch.column(0).slice(a, n), "n_tokens": np.diff(to), "ids": lists}, schema)

    return plain_documents(docs).mapInArrow(tidy(run), "doc_id long, n_tokens long, ids array<int>")


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load_merges(vocabulary)
        for batch in batches:
            yield batch_of({"doc_id": batch.column(0), "text": [decode(x or [], merges) for x in batch.column(1).to_pylist()]}, schema)

    return encoded.select("doc_id", "ids").mapInArrow(tidy(run), "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: ids written as decimals with commas, and the decoded text.

    Null or empty text: no ids, digests of the empty string. Null ids and repeated rows stay; further columns are not
    read; an empty table gives an empty one. There is no shuffle; memory holds 4 MB of text, or one longer text.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load_merges(vocabulary)
        written = [str(i) for i in range(max(merges.bytes_of) + 1)]
        for batch in batches:
            for a, n, ids, to in _encoded(batch.column(1), merges):
                first, second = [], []
                for i in range(n):
                    own = ids[to[i] : to[i + 1]].tolist()
                    first.append(hashlib.sha256(",".join([written[x] for x in own]).encode()).hexdigest())
                    second.append(hashlib.sha256(decode(own, merges).encode()).hexdigest())
                yield batch_of({"doc_id": batch.column(0).slice(a, n), "n_tokens": np.diff(to), "ids_sha256": first, "decoded_sha256": second}, schema)

    return plain_documents(docs).mapInArrow(tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
