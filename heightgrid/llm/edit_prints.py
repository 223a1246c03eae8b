"""Document fingerprints by a randomised edit embedding: shared random walks over characters, sampled at fixed steps.

A walk reads the character under it, writes it, and moves on or stays by a random bit that depends on the step and the
character. Two texts that differ by few edits fall back into step, so their edit distance becomes a Hamming distance of
what the walks write. A fingerprint keeps 64 steps of each octave of steps, four bits each.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heightgrid.llm.text import batch_of, chunks, mix, plain_documents, text_bytes
from heightgrid.session import checkpoint, worker_partitions

PER_OCTAVE = 64
#: Steps the random bits are drawn for; longer walks begin them anew.
PERIOD = 4096
#: Walks are looked over for finished ones after so many steps.
ROUND = 64
TEXT_CHARS = 8_000_000
BANDS, BAND_STEPS = 8, 6
#: Rows of a bucket in a block.
BLOCK = 512

_rng = np.random.Generator(np.random.PCG64(31415))
_MOVES = _rng.integers(0, 2, (PERIOD, 256), dtype=np.int8)
_HEX = np.frombuffer(b"0123456789abcdef.", np.uint8)
_ABSENT = 16


def sampled_steps(octaves: int) -> np.ndarray:
    """The steps a fingerprint keeps, in order: all of the first two octaves, then 64 of each."""
    steps = [np.arange(2 * PER_OCTAVE)]
    for k in range(1, octaves - 1):
        low = PER_OCTAVE << k
        r = np.random.Generator(np.random.PCG64(k))
        steps.append(np.sort(low + r.choice(low, PER_OCTAVE, replace=False)))
    return np.concatenate(steps)[: octaves * PER_OCTAVE]


def octave_weights(samples: int) -> np.ndarray:
    """How many steps each sample stands for."""
    octave = np.arange(samples) // PER_OCTAVE
    return 2.0 ** np.maximum(octave - 1, 0)


def classes(text: str) -> np.ndarray:
    """Characters as one of 256 classes each."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return (points * np.uint32(2654435761) >> np.uint32(24)).astype(np.uint8)


def walk(texts: list[str]) -> list[np.ndarray]:
    """Four bits of each sampled step for all texts, which walk side by side; a walk ends with its text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    letters = np.concatenate([*map(classes, texts), np.zeros(ROUND + 1, np.uint8)])
    who = np.flatnonzero(sizes > 0)
    at = (ends - sizes)[who].astype(np.int64)
    end = ends[who]
    octaves = 2
    steps = sampled_steps(octaves)
    out = np.full((len(texts), octaves * PER_OCTAVE), _ABSENT, np.uint8)
    parts = [out]
    rows = np.arange(len(texts))
    step = column = 0
    while len(who):
        if column >= len(steps):
            octaves += 1
            steps = sampled_steps(octaves)
            rows = who  # only walks that still go on have samples of later octaves
            parts.append((np.array(rows), np.full((len(rows), PER_OCTAVE), _ABSENT, np.uint8)))
        stop = step + ROUND
        while step < stop:
            seen = letters[at]
            if column < len(steps) and steps[column] == step:
                value = (seen * np.uint8(37) + np.uint8(step * 101 & 255)) * np.uint8(167) >> np.uint8(4)
                value = np.where(at < end, value, _ABSENT).astype(np.uint8)
                if column < 2 * PER_OCTAVE:
                    out[who, column] = value
                else:
                    owners, table = parts[-1]
                    table[np.searchsorted(owners, who), column % PER_OCTAVE] = value
                column += 1
            at += _MOVES[step % PERIOD].take(seen)
            np.minimum(at, end, out=at) if step % 16 == 15 else None
            step += 1
        alive = at < end
        if not alive.all():
            who, at, end = who[alive], at[alive], end[alive]
    found = list(out)
    for owners, table in parts[1:]:
        for i, row in zip(owners.tolist(), table, strict=True):
            found[i] = np.concatenate([found[i], row])
    return found


def as_text(samples: np.ndarray) -> str:
    """Hexadecimal, one letter for each sample; samples behind the text's end are cut off."""
    return _HEX[samples].tobytes().decode().rstrip(".")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal steps among those that either text has; two empty texts are alike."""
    n = max(len(a), len(b))
    x, y = (np.append(v, np.full(n - len(v), _ABSENT, np.uint8)) for v in (a, b))
    present = (x != _ABSENT) | (y != _ABSENT)
    w = octave_weights(n) * present
    total = w.sum()
    return float((w * (x == y)).sum() / total) if total else 1.0


def edited(text: str, other: str) -> str:
    """The text with its last third replaced by as many first characters of the other, or all it has."""
    k = len(text) // 3
    return text[: len(text) - k] + other[:k]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row; null and empty texts have an empty fingerprint. No shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in _slices(batch.column(1).to_pylist()):
                prints = [as_text(s) for s in walk(texts)]
                yield batch_of({"doc_id": batch.column(0).slice(a, len(texts)), "n_chars": [len(t) for t in texts], "fingerprint": prints}, schema)

    return plain_documents(docs).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    a = size = 0
    some: list[str] = []
    for i, t in enumerate(texts):
        some.append(t or "")
        size += len(some[-1])
        if size >= TEXT_CHARS or i == len(texts) - 1:
            yield a, some
            a, size, some = i + 1, 0, []


def _number_below(value: Column, bounds: list[int]) -> Column:
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def below(v: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, v.to_numpy(), "left"), dtype="int32")

    return below(value)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document's.

    The next document follows in descending id order, the first after the last. Documents are dealt to buckets of ids by
    their quantiles, four buckets for each partition, and each bucket gets a copy of the next bucket's first document:
    one shuffle of the texts, and one row per bucket on the driver.

    Null or empty text: an empty fingerprint, nothing to edit; two empty texts are alike (1), an empty and another are
    not (0). A null id counts as the smallest. Rows that repeat an id follow each other by text. A single document is
    its own next. An empty table gives an empty one; further columns are not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = -(1 << 63)
    keyed = plain_documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(lowest)).alias("key"))
    ids = keyed.select("key")
    n = 4 * parts
    found = ids.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    bounds = sorted(set(found))
    dealt = keyed.withColumn("bucket", -_number_below(F.col("key"), bounds))
    heads = sorted((r.bucket, r.head) for r in ids.select((-_number_below(F.col("key"), bounds)).alias("bucket"), "key").groupBy("bucket").agg(F.max("key").alias("head")).collect())
    wanted = [(bucket, heads[(i + 1) % len(heads)][1]) for i, (bucket, _) in enumerate(heads)]
    table = spark.createDataFrame(wanted, "bucket int, key long")
    first = keyed.join(F.broadcast(table.select("key").distinct()), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    first = first.join(F.broadcast(table), "key").select(F.lit(None).cast("long").alias("doc_id"), "text", "key", "bucket", F.lit(1).alias("borrowed"))
    lined = (
        dealt.select("doc_id", "text", "key", "bucket", F.lit(0).alias("borrowed"))
        .unionByName(first)
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "borrowed", F.col("key").desc(), "text")
        .select("doc_id", "text", "borrowed")
    )
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    schema = pa.schema(list(zip(names, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for a, b in chunks(text_bytes(batch.column(1))[1], TEXT_CHARS):
                rows = held + list(zip(*(c.slice(a, b - a).to_pylist() for c in batch.columns), strict=True))
                yield _compared(rows, schema)
                held = rows[-1:]

    types = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return lined.mapInArrow(run, types)


def _compared(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Results for all rows but the last, which is only looked at, and but the borrowed ones."""
    texts = [r[1] for r in rows]
    prints = walk(texts)
    own = [i for i in range(len(rows) - 1) if not rows[i][2]]
    changed = [edited(texts[i], texts[i + 1]) for i in own]
    edited_prints = walk(changed)
    return batch_of(
        {
            "doc_id": [rows[i][0] for i in own],
            "n_chars": [len(texts[i]) for i in own],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": [as_text(prints[i]) for i in own],
            "edited_fingerprint": [as_text(p) for p in edited_prints],
            "near_edited": [likeness(prints[i], p) for i, p in zip(own, edited_prints, strict=True)],
            "near_next": [likeness(prints[i], prints[i + 1]) for i in own],
        },
        schema,
    )


def band_keys(samples: np.ndarray) -> list[int]:
    """Keys of steps drawn from the last two octaves that the text fills, with the octave.

    A text that fills none has its own keys, of steps drawn from those it has in three sizes: from its first 8, 16, 32
    and so on, so that texts of different lengths meet in what both have.
    """
    filled = (samples.reshape(-1, PER_OCTAVE) != _ABSENT).all(axis=1).sum()
    # a text that fills one octave at most also meets those that fill none
    spans = [(1_000_000 + n, 0, n) for n in (1, 2, 4, 8, 16, 32, 64) if n <= (samples != _ABSENT).sum()][-3:] if filled < 2 else []
    spans += [(octave, octave * PER_OCTAVE, PER_OCTAVE) for octave in range(max(0, filled - 2), filled)]
    keys = []
    for name, start, n in spans:
        own = samples[start : start + n].astype(np.uint64)
        for b in range(BANDS):
            pick = np.random.Generator(np.random.PCG64([name, b])).choice(n, min(BAND_STEPS, n), replace=False)
            key = np.array([name * 1_000 + b], np.uint64)
            for v in own[pick]:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + v)
            keys.append(int(key.view(np.int64)[0]))
    return keys


def near_texts(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """``a, b, likeness``: links between documents that share a band and whose fingerprints are as near as ``least``.

    Equal fingerprints are linked to their smallest id and go on as one. In each bucket all others are compared,
    those that have become connected within their two blocks excepted, so a group of near texts gives links that connect
    it and not all pairs.
    A bucket's members are dealt to blocks; a row goes to each pair of blocks it belongs to, and pairs never become rows.
    An id repeated with other texts is compared by each text; links of an id with itself are left out.
    """
    spark = docs.sparkSession
    printed = checkpoint(fingerprints(docs).where(F.col("doc_id").isNotNull() & (F.col("fingerprint") != "")).select("doc_id", "fingerprint").distinct())
    classes = checkpoint(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")))

    @F.pandas_udf("array<long>")
    def keys(v: pd.Series) -> pd.Series:
        return v.map(lambda t: band_keys(_samples(t)))

    banded = classes.select("a", "fingerprint", F.explode(F.array_distinct(keys("fingerprint"))).alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = banded.join(shared, "key").withColumn("own", F.pmod(F.xxhash64("fingerprint", "key"), blocks).cast("int"))
    spread = (
        dealt.select("key", "own", "a", "fingerprint", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        .select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "a", "fingerprint")
        .repartition(worker_partitions(spark), "key", "x", "y")
        .sortWithinPartitions("key", "x", "y", "a", "fingerprint")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("likeness", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for _, group in itertools.groupby(rows, key=lambda r: r[:3]):
            links = _links([r[3:] for r in group], least)
            if links:
                yield batch_of(dict(zip(schema.names, zip(*links, strict=True), strict=True)), schema)

    copies = printed.join(classes.where("n > 1"), "fingerprint").where("a < doc_id").select("a", F.col("doc_id").alias("b"), F.lit(1.0).alias("likeness"))
    found = spread.mapInArrow(run, "a long, b long, likeness double")
    return copies.union(found).groupBy("a", "b").agg(F.max("likeness").alias("likeness"))


def _links(members: list[tuple[int, int, str]], least: float) -> list[tuple[int, int, float]]:
    """Links within one pair of blocks, from each row's block, id and fingerprint; two blocks are compared across only."""
    samples = [_samples(m[2]) for m in members]
    n = max(map(len, samples))
    table = np.full((len(members), n), _ABSENT, np.uint8)
    for row, s in zip(table, samples, strict=True):
        row[: len(s)] = s
    own, ids = (np.array([m[i] for m in members]) for i in (0, 1))
    label, weights, links = np.arange(len(members)), octave_weights(n), []
    across = own.min() < own.max()
    for r in range(1, len(members)):
        c = np.flatnonzero((label[:r] != label[r]) & ((own[:r] != own[r]) if across else True))
        w = weights * ((table[c] != _ABSENT) | (table[r] != _ABSENT))
        near = (w * (table[c] == table[r])).sum(axis=1) / w.sum(axis=1)
        for k in np.argsort(-near, kind="stable"):
            if near[k] < least:
                break
            if label[c[k]] != label[r]:
                label[label == label[c[k]]] = label[r]
                if ids[c[k]] != ids[r]:
                    links.append((int(min(ids[c[k]], ids[r])), int(max(ids[c[k]], ids[r])), float(near[k])))
    return links


def _samples(text: str) -> np.ndarray:
    """Samples of a fingerprint, filled up to whole octaves."""
    n = -(-max(len(text), 1) // PER_OCTAVE) * PER_OCTAVE
    raw = np.frombuffer(text.ljust(max(n, 2 * PER_OCTAVE), ".").encode(), np.uint8)
    return np.where(raw == 46, _ABSENT, np.where(raw >= 97, raw - 87, raw - 48)).astype(np.uint8)
