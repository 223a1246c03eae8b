"""Language-model scoring by context-tree weighting over bytes, next to a plain word model.

A byte is eight binary decisions, each with the bytes before it as context, up to five. Every node of a context and a
decision holds a Krichevsky-Trofimov estimate; the weighting of a node against its longer contexts follows from their
probabilities of all training text. The score of a text is the sum over its bytes and an end mark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heightgrid.llm.text import LOWER, U, batch_of, chunks, find_words, mix, plain_documents, release, span_hashes, text_bytes, tidy
from heightgrid.session import checkpoint, worker_partitions

#: Bytes of context.
DEPTH = 5
#: Byte strings a task gathers before it passes them on, and the text worked on at a time.
MEMORY, TEXT_BYTES, GRAM_BYTES = 1 << 20, 32_000_000, 1_000_000
#: Keys a task works on together, as far as whole groups of them allow.
GROUPED = 60_000
#: Groups of word hashes for each partition of a shuffle.
WORD_GROUPS = 16
END = 0xFF
WORD, GRAM, TEXT = range(3)
#: Bits below the last two bytes of context.
_NEAR = 8 * (DEPTH - 1)


def is_held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every row and its end mark, the byte below its context, nearest byte uppermost; and row offsets.

    Bit 32 and up hold the last byte, then those before it, and the lowest eight bits the byte itself. Zeros stand
    before the first byte.
    """
    n = len(offsets) - 1
    room = DEPTH + 1
    sizes = np.diff(offsets)
    line = np.zeros(len(data) + room * n, np.uint8)
    line[np.arange(len(data)) + np.repeat(room * np.arange(n) + DEPTH, sizes)] = LOWER[data]
    starts = offsets[:-1] + room * np.arange(n) + DEPTH
    line[starts + sizes] = END
    use = np.ones(len(line), bool)
    for d in range(1, DEPTH + 1):
        use[starts - d] = False
    wide = line.astype(np.int64)
    key = wide[DEPTH:].copy()
    for d in range(1, DEPTH + 1):
        key |= wide[DEPTH - d : len(wide) - d] << (8 * (DEPTH + 1 - d))
    return key[use[DEPTH:]], offsets + np.arange(n + 1)


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs."""
    if weights is not None:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    else:
        keys = np.sort(keys)
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    at = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    return keys[at], np.diff(np.append(at, len(keys))) if weights is None else np.add.reduceat(weights, at)


def gram_counts(texts: DataFrame) -> DataFrame:
    """``key, n`` over all rows: counted within tasks first."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a, b in chunks(offsets, GRAM_BYTES):
                k, n = _counted(grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[0])
                keys, counts = _counted(np.concatenate([keys, k]), np.concatenate([counts, n]))
                if len(keys) > MEMORY:
                    yield batch_of({"key": keys, "n": counts}, schema)
                    keys, counts = keys[:0], counts[:0]
        yield batch_of({"key": keys, "n": counts}, schema)

    return texts.select("text").mapInArrow(tidy(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 0.5 by Stirling's series, after moving small arguments up."""
    x = np.asarray(x, float).copy()
    shift = np.zeros_like(x)
    for _ in range(8):
        small = x < 8
        shift = np.where(small, shift - np.log(x), shift)
        x = np.where(small, x + 1, x)
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def log_evidence(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln probability the Krichevsky-Trofimov estimator gives a string of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


def decisions(keys: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of one depth, sorted: code (context, then the bits so far behind a leading one), zeros and ones."""
    k, n = _counted((keys >> (8 * (DEPTH + 1 - depth))) << 8 | (keys & 0xFF), counts)
    codes, zeros, ones = [], [], []
    for bit in range(8):
        group = k >> (8 - bit)
        at = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1]) if len(k) else np.zeros(0, np.int64)
        one = np.where(k >> (7 - bit) & 1, n, 0)
        codes.append((k[at] >> 8) << 8 | (1 << bit) | (k[at] & 0xFF) >> (8 - bit))
        ones.append(np.add.reduceat(one, at) if len(k) else one)
        zeros.append((np.add.reduceat(n, at) if len(k) else n) - ones[-1])
    code, zero, one = (np.concatenate(x) for x in (codes, zeros, ones))
    order = np.argsort(code)
    return code[order], zero[order], one[order]


def parent(code: np.ndarray) -> np.ndarray:
    """The node with one byte of context less and the same bits."""
    return (code >> 16) << 8 | (code & 0xFF)


def weighted(code: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """ln weighted probability of each node, and the weight of its own estimate against its longer contexts."""
    own = log_evidence(zeros, ones)
    if below is None:
        return own, np.ones(len(code))
    total = np.logaddexp(own, below) - np.log(2)
    return total, np.exp(own - np.log(2) - total)


Nodes = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass
class Model:
    """Nodes of each depth from none to five bytes of context: sorted code, probability of a one, own weight."""

    nodes: list[Nodes]

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the byte in each key after its context.

        From the longest context that was seen to the shortest, the estimate is the node's own and that of the longer
        context in the node's weights; contexts that were not seen leave it to the next shorter one.
        """
        total = np.zeros(len(keys))
        for bit in range(8):
            byte = keys & 0xFF
            bits = (1 << bit) | byte >> (8 - bit)
            p, has = np.full(len(keys), 0.5), np.zeros(len(keys), bool)
            for depth in range(DEPTH, -1, -1):
                known, table_one, table_own = self.nodes[depth]
                if not len(known):
                    continue
                code = (keys >> (8 * (DEPTH + 1 - depth))) << 8 | bits
                at = np.minimum(np.searchsorted(known, code), len(known) - 1)
                seen, one, own = known[at] == code, table_one[at], table_own[at]
                p = np.where(seen, np.where(has, own * one + (1 - own) * p, one), p)
                has |= seen
            total += np.log10(np.where(byte >> (7 - bit) & 1, p, 1 - p))
        return total


def long_nodes(keys: np.ndarray, counts: np.ndarray) -> tuple[list[Nodes], tuple[np.ndarray, ...]]:
    """Nodes of two to five bytes, and for one byte the code, zeros, ones and the sum over its longer contexts.

    ``keys`` hold every training context that shares its last two bytes with one of them.
    """
    made: list[Nodes] = []
    below: tuple[np.ndarray, np.ndarray] | None = None
    for depth in range(DEPTH, 0, -1):
        code, zeros, ones = decisions(keys, counts, depth)
        rest = np.zeros(len(code))
        if below is not None:
            np.add.at(rest, np.searchsorted(code, parent(below[0])), below[1])
        if depth == 1:
            return made[::-1], (code, zeros, ones, rest)
        total, own = weighted(code, zeros, ones, None if below is None else rest)
        made.append((code, (ones + 0.5) / (zeros + ones + 1), own))
        below = (code, total)
    raise AssertionError


def packed_keys(keys: np.ndarray) -> bytes:
    """Ordered keys as steps from one to the next, byte by byte, compressed."""
    return _packed(np.diff(keys, prepend=0))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers.astype(np.int64)).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(data: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1).T.copy().view(kind).reshape(-1)


def packed_rows(keys: np.ndarray, counts: np.ndarray, low: int) -> tuple[list[int], list[bytes], list[bytes]]:
    """Ordered keys and their counts, one packed row for all that differ in the lowest ``low`` bits only."""
    near = keys >> low
    at = np.concatenate([[0], np.flatnonzero(near[1:] != near[:-1]) + 1, [len(keys)]]) if len(keys) else np.zeros(1, np.int64)
    pieces = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
    return near[at[:-1]].tolist() if len(keys) else [], [packed_keys(keys[i:j]) for i, j in pieces], [_packed(counts[i:j]) for i, j in pieces]


def _near_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple]]]:
    """Keys and counts of packed rows sorted by ``key``, in pieces that hold whole groups of it; and the rows."""
    held: list[tuple] = []
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("batch", "key", "packed", "counts"))
        for number, near, packed, n in zip(*columns, strict=True):
            if held and near != held[-1][1] and sum(map(len, keys)) > GROUPED:
                yield np.concatenate(keys), np.concatenate(counts), held
                held, keys, counts = [], [], []
            keys.append(unpacked_keys(packed))
            counts.append(_unpacked(n))
            held.append((number, near, packed))
    if held:
        yield np.concatenate(keys), np.concatenate(counts), held


def _by_near(grams: DataFrame) -> DataFrame:
    return grams.select("batch", "key", "packed", "counts").repartition(worker_partitions(grams.sparkSession), "key").sortWithinPartitions("key")


def _short(code: np.ndarray, zeros: np.ndarray, ones: np.ndarray, rest: np.ndarray) -> list[Nodes]:
    """Nodes of none and one byte of context; ``rest`` sums over the longer contexts of each of the latter."""
    total, own = weighted(code, zeros, ones, rest)
    one_byte = (code, (ones + 0.5) / (zeros + ones + 1), own)
    root, at = np.unique(code & 0xFF, return_inverse=True)
    z, o, b = (np.bincount(at, weights=x, minlength=len(root)) for x in (zeros, ones, total))
    return [(root, (o + 0.5) / (z + o + 1), weighted(root, z, o, b)[1]), one_byte]


def short_nodes(grams: DataFrame) -> list[Nodes]:
    """Nodes of none and one byte of context from packed rows of training counts (zeros for what only other texts hold).

    Contexts with the same last two bytes meet in one task, and their sums make the shorter ones. What reaches the driver
    is at most 65,536 nodes.
    """
    schema = pa.schema([("code", pa.int64()), ("zeros", pa.int64()), ("ones", pa.int64()), ("below", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, _ in _near_groups(batches):
            distinct, counts = _counted(keys, n)
            if (counts > 0).any():
                yield batch_of(dict(zip(schema.names, long_nodes(distinct[counts > 0], counts[counts > 0])[1], strict=True)), schema)

    made = _by_near(grams).mapInArrow(tidy(run), "code long, zeros long, ones long, below double")
    first = made.groupBy("code").agg(*[F.sum(c).alias(c) for c in schema.names[1:]]).toArrow().sort_by("code")
    return _short(*(first.column(c).to_numpy() for c in schema.names))


def fit(texts: DataFrame) -> Model:
    """The model of a small table of training texts with all its nodes in one place; ``score`` never gathers them."""
    every = gram_counts(texts).toArrow()
    long, rest = long_nodes(*_counted(every.column("key").to_numpy(), every.column("n").to_numpy()))
    return Model([*_short(*rest), *long])


def gram_scores(grams: DataFrame) -> DataFrame:
    """``batch, key, packed, scores``: log10 probability of each key in a packed row, given the counts of all rows.

    Every node is used. Those of two and more bytes are made where their contexts meet, once for the sums of the shorter
    ones and once for the values, and are never stored: a task holds those of some groups of two bytes of context.
    """
    short = grams.sparkSession.sparkContext.broadcast(short_nodes(grams))
    schema = pa.schema([("batch", pa.int64()), ("key", pa.int64()), ("packed", pa.binary()), ("scores", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, rows in _near_groups(batches):
            distinct, counts = _counted(keys, n)
            seen = counts > 0
            model = Model([*short.value, *long_nodes(distinct[seen], counts[seen])[0]])
            value = np.concatenate([model.log10(distinct[i : i + 20_000]) for i in range(0, len(distinct), 20_000)])
            for i in range(0, len(rows), 256):
                some = rows[i : i + 256]
                scores = [_packed(value[np.searchsorted(distinct, unpacked_keys(packed))].view(np.int64)) for _, _, packed in some]
                yield batch_of({"batch": [r[0] for r in some], "key": [r[1] for r in some], "packed": [r[2] for r in some], "scores": scores}, schema)

    return _by_near(grams).mapInArrow(tidy(run), "batch long, key long, packed binary, scores binary")


def word_counts(words: DataFrame) -> DataFrame:
    """``batch, key, packed, scores, kinds, total``: how often each word of a packed row occurs in training rows of all batches.

    ``kinds`` and ``total`` add up to the distinct and all training words of a group; they stand in one of its rows.
    """
    types = "batch long, key long, packed binary, scores binary, kinds long, total long"
    schema = pa.schema([("batch", pa.int64()), ("key", pa.int64()), ("packed", pa.binary()), ("scores", pa.binary()), ("kinds", pa.int64()), ("total", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, rows in _near_groups(batches):
            distinct, counts = _counted(keys, n)
            numbers, groups, packed = zip(*rows, strict=True)
            scores = [_packed(counts[np.searchsorted(distinct, unpacked_keys(x))]) for x in packed]
            first = np.arange(len(rows)) == 0
            sums = {"kinds": first * np.count_nonzero(counts), "total": first * counts.sum()}
            yield batch_of({"batch": numbers, "key": groups, "packed": packed, "scores": scores, **sums}, schema)

    return _by_near(words).mapInArrow(tidy(run), types)


class Lookup:
    """Values of distinct keys, most of them found at one place of a hash table and the others by halving."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.sorted, self.values = keys[order], values[order]
        self.mask = U(min(1 << 22, 1 << (4 * len(keys)).bit_length()) - 1)
        place = self._place(self.sorted)
        self.at = np.zeros(int(self.mask) + 1, np.int32)
        self.at[place] = np.arange(len(keys), dtype=np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64)) & self.mask).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, self.values.dtype)
        at = self.at[self._place(keys)]
        other = np.flatnonzero(self.sorted[at] != keys)
        at[other] = np.searchsorted(self.sorted, keys[other])
        return self.values[at]


def _looked_up(rows: pa.Table, kind: type) -> Lookup:
    """Values of all keys in packed rows."""
    rows = rows.sort_by("key")
    keys = [unpacked_keys(x.as_py()) for x in rows.column("packed")]
    values = [_unpacked(x.as_py(), kind) for x in rows.column("scores")]
    return Lookup(np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, kind), *values]))


class Counter:
    """Distinct keys of all rows and how often each occurs in training rows."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, held: np.ndarray) -> None:
        k, n = _counted(keys[~held])
        other = _counted(keys[held])[0]
        self.keys, self.counts = _counted(np.concatenate([self.keys, k, other]), np.concatenate([self.counts, n, np.zeros(len(other), np.int64)]))


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Both models must look up every byte string and word of every text, and their tables grow with the corpus. A task
    therefore gathers the distinct ones of each 32 MB of text, and writes them next to the packed texts; only they are
    joined with the models, and their values come back to their batch. Words are known by 64-bit hashes. Both travel in
    packed groups, strings by their last two bytes of context and words by the upper bits of their hash, so a frequent
    word is one entry of a group in each batch and never a key of its own.

    Null or empty text: its end mark alone. A null id is a training document. Repeated rows count and score each for
    itself. Without training text every estimate is one half and the word model's counts are zero. An empty table gives
    an empty one; further columns are not read.
    """
    texts = plain_documents(docs, is_held_out().alias("held_out"))
    word_bits = 64 - (WORD_GROUPS * worker_partitions(docs.sparkSession) - 1).bit_length()
    names = ("batch", "kind", "key", "doc_ids", "held_out", "sizes", "packed", "counts")
    longs = pa.list_(pa.int64())
    kinds = (pa.int64(), pa.int32(), pa.int64(), longs, pa.list_(pa.bool_()), longs, pa.binary(), pa.binary())
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def filled(number: int, kind: int, found: Counter, low: int) -> Iterator[pa.RecordBatch]:
        near, keys, counts = packed_rows(found.keys, found.counts, low)
        for i in range(0, len(near), 256):
            some = {"key": near[i : i + 256], "packed": keys[i : i + 256], "counts": counts[i : i + 256]}
            m = len(some["key"])
            nothing = {x: pa.nulls(m, schema.field(x).type) for x in names if x not in some}
            yield batch_of({**nothing, "batch": np.full(m, number), "kind": np.full(m, kind, np.int32), **some}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            held = np.array(batch.column(2).to_pylist(), bool)
            for a, b in chunks(offsets, TEXT_BYTES):
                found = {WORD: Counter(), GRAM: Counter()}
                for i, j in chunks(offsets[a : b + 1], GRAM_BYTES):
                    i, j = a + i, a + j
                    own = offsets[i : j + 1]
                    part, own = data[own[0] : own[-1]], own - own[0]
                    keys, rows = grams(part, own)
                    found[GRAM].add(keys, np.repeat(held[i:j], np.diff(rows)))
                    starts, ends, first = find_words(part, own)
                    found[WORD].add(span_hashes(part, starts, ends, lower=True).view(np.int64), np.repeat(held[i:j], np.diff(first)))
                    text = {"doc_ids": [batch.column(0).slice(i, j - i).to_pylist()], "held_out": [held[i:j]], "sizes": [np.diff(own)], "packed": [packer.compress(part.tobytes())]}
                    yield batch_of({"batch": [number], "kind": [TEXT], "key": [None], **text, "counts": [None]}, schema)
                yield from filled(number, WORD, found[WORD], word_bits)
                yield from filled(number, GRAM, found[GRAM], _NEAR)
                number += 1

    coded = checkpoint(texts.mapInArrow(tidy(run), "batch long, kind int, key long, doc_ids array<long>, held_out array<boolean>, sizes array<long>, packed binary, counts binary"))
    coming = checkpoint(word_counts(coded.where(F.col("kind") == WORD)))
    trained_rows = F.size(F.filter("held_out", lambda x: ~x))
    ends = coded.where(F.col("kind") == TEXT).agg(F.coalesce(F.sum(trained_rows), F.lit(0))).first()[0]
    totals = coming.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("kinds", "total")]).first()
    trained, kinds_ = totals.total + ends, totals.kinds + (ends > 0)
    whole = np.log10(trained + 0.5 * (kinds_ + 1))
    end_score, end_known = float(np.log10(ends + 0.5)), int(ends > 0)
    result = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )

    def look_up(rows: pa.Table, values: pa.Table) -> pa.Table:
        words, strings = (_looked_up(values.filter(pc.equal(values.column("kind"), kind)), of) for kind, of in ((WORD, np.int64), (GRAM, np.float64)))
        unpacker, made = zstandard.ZstdDecompressor(), []
        for ids, held, sizes, packed in zip(*(rows.column(c) for c in ("doc_ids", "held_out", "sizes", "packed")), strict=True):
            offsets = np.concatenate([[0], np.cumsum(sizes.values.to_numpy())])
            data, n = np.frombuffer(unpacker.decompress(packed.as_py()), np.uint8), len(offsets) - 1
            keys, first = grams(data, offsets)
            scores = np.add.reduceat(strings[keys], first[:-1])
            starts, ends, first = find_words(data, offsets)
            c, row = words[span_hashes(data, starts, ends, lower=True).view(np.int64)], np.repeat(np.arange(n), np.diff(first))
            tokens = np.diff(first) + 1
            base = np.bincount(row, np.log10(c + 0.5), n) + end_score - tokens * whole
            hits = np.bincount(row[c > 0], minlength=n) + end_known
            out = {"doc_id": ids.values, "held_out": held.values, "n_tokens": tokens, "n_known": hits, "train_tokens": np.full(n, trained), "base_score": base, "score": scores}
            made.append(batch_of(out, result))
        del words, strings
        release()
        return pa.Table.from_batches(made, result)

    rows = coded.where(F.col("kind") == TEXT).select("batch", "doc_ids", "held_out", "sizes", "packed")
    scored = gram_scores(coded.where(F.col("kind") == GRAM)).select("batch", F.lit(GRAM).alias("kind"), "key", "packed", "scores")
    values = coming.select("batch", F.lit(WORD).alias("kind"), "key", "packed", "scores").unionByName(scored)
    types = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("batch").cogroup(values.groupBy("batch")).applyInArrow(look_up, types)
