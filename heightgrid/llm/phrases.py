"""Phrases whose words stand together more often than their parts explain, found by dynamic itemset counting.

Documents are dealt into a few shards, which are scanned in turn, again and again. Words count from the first scan. A
longer phrase counts from the scan after both of its parts that are one word shorter have reached the threshold, also
while those are still being counted, so lengths are interleaved; and it counts for one full cycle of shards, which gives
its exact frequency. The search ends when no phrase is within its cycle.

When a phrase began to count follows from a table of fixed size that says for each slot in which scan a phrase of that
slot reached the threshold first. Slots hold hashes: two phrases in one slot make others count that need not, never
fewer, and the start of a phrase does not change later, so its cycle is full. Counts are numbers under 64-bit hashes of
language and words, packed by ranges of the hash; a task sums what it sees before it passes it on, and what completes
its cycle below the threshold is let go. A last reading gives the frequent hashes their words. Two phrases of one hash
would share a count; with a million frequent and ten thousand million other phrases the odds for any are 5 in 10,000.

Defined results: a null text is empty, a null language ``und``; repeated rows count as often as they stand there; an
empty table gives no rows; further columns are left behind. Memory follows 2 MB of text in a task, or the longest text
where that is more, and the counts of one range of hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heightgrid.llm.text import LOWER, U, batch_of, chunks, mix, rolled, span_hashes, text_bytes
from heightgrid.session import checkpoint, scratch_path, worker_partitions

#: Longest phrase, text worked on at a time, counts a task gathers before it passes them on.
LONGEST, TEXT_BYTES, GATHERED = 5, 2_000_000, 2_000_000
#: Slots of the table of starts (one byte each), and the mark of a slot that nothing has reached.
SLOTS, NEVER = 1 << 22, 255
#: Ranges of hashes per partition.
RANGES = 4
#: Bits of the filter for the hashes that still want their words, and the sixteenths of the documents that are searched for them in turn.
WANTED, TURNS = 1 << 26, ((0, 1), (1, 4), (4, 16))

BREAK, GAP = np.zeros(256, bool), np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
GAP[[32, 9]] = True

COUNTS = pa.schema([("range", pa.int32()), ("packed", pa.binary())])
STATE = pa.schema([("frequent", pa.bool_()), ("range", pa.int32()), ("packed", pa.binary()), ("reached", pa.list_(pa.int32()))])
NAMES = pa.schema([("key", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("n_words", pa.int32()), ("total", pa.int64())])
PAIR = pa.schema([("key", pa.int64()), ("a", pa.int64())])
#: A count: hash, number, scan of the start, words, whether it reached the threshold.
RECORD = np.dtype([("key", "u8"), ("n", "i8"), ("start", "u1"), ("words", "u1"), ("reached", "u1")])


class Words:
    """Words of some texts, lower-cased and spaced by one blank, and the hashes of phrases that begin with each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray):
        """``languages``: a hash for each text."""
        inside = ~(BREAK | GAP)[data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        rows = offsets[:-1][offsets[:-1] < len(data)]
        begin[rows] = inside[rows]
        final = inside
        final[:-1] &= ~inside[1:] | begin[1:]
        self.data, self.starts, self.ends = data, np.flatnonzero(begin), np.flatnonzero(final) + 1
        self.row = np.searchsorted(offsets, self.starts, "right") - 1
        breaks = np.cumsum(BREAK[data], dtype=np.int64)
        piece = breaks[self.starts] if len(self.starts) else np.zeros(0, np.int64)
        self.linked = (piece[1:] == piece[:-1]) & (self.row[1:] == self.row[:-1])
        self.hashes = mix(span_hashes(data, self.starts, self.ends, lower=True) + languages[self.row])

    def keys(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For every length the hashes of the phrases at each word, and which of them lie within one piece."""
        whole = np.ones(len(self.hashes), bool)
        for n in range(1, LONGEST + 1):
            if n > 1:
                whole = whole[: len(self.hashes) - n + 1] & self.linked[n - 2 :]
            yield n, rolled(self.hashes, n), whole
            if len(self.hashes) <= n:
                return

    def phrase(self, first: np.ndarray, n: int) -> list[str]:
        """Phrases of ``n`` words from the given words on."""
        low = LOWER[self.data].tobytes()
        return [b" ".join(low[self.starts[j] : self.ends[j]] for j in range(i, i + n)).decode("utf-8") for i in first.tolist()]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """Words of each chunk of ``lang, text``, and the languages of its rows."""
    for batch in batches:
        names = batch.column("lang").to_pylist()
        data, offsets = text_bytes(batch.column("text"))
        seed, ends = text_bytes(batch.column("lang"))
        languages = mix(~span_hashes(seed, ends[:-1], ends[1:]))  # not what the word of the same letters has
        for a, b in chunks(offsets, TEXT_BYTES):
            yield Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], languages[a:b]), names[a:b]


def active(words: Words, started: np.ndarray, scan: int, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, hashes and starts of all phrases that count in this scan."""
    before = None
    for n, keys, whole in words.keys():
        if n == 1:
            if scan < shards and len(keys):
                yield 1, keys, np.zeros(len(keys), np.uint8)
        else:
            part = started[(before & U(len(started) - 1)).astype(np.int64)]
            start = np.maximum(part[:-1], part[1:]).astype(np.int64) + 1
            on = np.flatnonzero(whole & (start <= scan) & (start > scan - shards))
            if len(on):
                yield n, keys[on], start[on].astype(np.uint8)
        before = keys


def added(parts: list[np.ndarray]) -> np.ndarray:
    """One record per hash, in order, numbers added up."""
    records = np.concatenate(parts) if parts else np.zeros(0, RECORD)
    if not len(records):
        return records
    order = np.argsort(records["key"], kind="stable")
    keys = records["key"][order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    out = records[order[first]]
    out["n"] = np.add.reduceat(records["n"][order], first)
    out["reached"] = np.maximum.reduceat(records["reached"][order], first)
    return out


def packed(records: np.ndarray) -> bytes:
    """Ordered records byte by byte of their columns, hashes as steps from one to the next, compressed."""
    steps = records.copy()
    steps["key"][1:] -= records["key"][:-1]
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(len(steps), RECORD.itemsize).T.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(RECORD.itemsize, -1)
    out = planes.T.copy().view(RECORD).reshape(-1)
    out["key"] = np.cumsum(out["key"], dtype=np.uint64)
    return out


def _ranged(records: np.ndarray, ranges: int) -> pa.RecordBatch:
    """Ordered records, a row for each range of hashes."""
    cuts = np.searchsorted(records["key"], (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64))
    bounds = [0, *cuts.tolist(), len(records)]
    full = [r for r in range(ranges) if bounds[r] < bounds[r + 1]]
    return batch_of({"range": full, "packed": [packed(records[bounds[r] : bounds[r + 1]]) for r in full]}, COUNTS)


def _counter(started, scan: int, shards: int, ranges: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Summed counts of what is active, as packed records by range."""
        parts, held = [], 0
        for words, _ in _batches(batches):
            for n, keys, start in active(words, started.value, scan, shards):
                order = np.argsort(keys)
                ordered = keys[order]
                first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
                made = np.zeros(len(first), RECORD)
                made["key"], made["words"], made["start"] = ordered[first], n, start[order[first]]
                made["n"] = np.diff(np.append(first, len(ordered)))
                parts.append(made)
                held += len(made)
            if held > GATHERED:
                parts = [added(parts)]
                held = len(parts[0])
                if held > GATHERED // 2:
                    yield _ranged(parts[0], ranges)
                    parts, held = [], 0
        if held:
            yield _ranged(added(parts), ranges)

    return count


def _merger(scan: int, shards: int, threshold: int, slots: int):
    def settle(number: int, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        records = added(parts)
        new = (records["n"] >= threshold) & (records["reached"] == 0)
        longer = new & (records["words"] < LONGEST)
        reached = np.unique(records["key"][longer] & U(slots - 1)).astype(np.int32)
        records["reached"] |= new
        done = records["start"].astype(np.int64) + shards - 1 <= scan
        for frequent, some in ((True, records[done & (records["reached"] > 0)]), (False, records[~done])):
            if len(some) or (not frequent and len(reached)):
                yield batch_of({"frequent": [frequent], "range": [number], "packed": [packed(some)], "reached": [[] if frequent else reached]}, STATE)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of each range with what earlier scans left of it; rows of a range follow each other."""
        now, parts, held = None, [], 0
        for batch in batches:
            for number, data in zip(batch.column("range").to_pylist(), batch.column("packed"), strict=True):
                if number != now:
                    if parts:
                        yield from settle(now, parts)
                    now, parts, held = number, [], 0
                parts.append(unpacked(data.as_buffer()))
                held += len(parts[-1])
                if held > 2 * GATHERED:
                    parts = [added(parts)]
                    held = 0
        if parts:
            yield from settle(now, parts)

    return merge


def _namer(wanted):
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words of every phrase whose hash may be wanted, but not again what was seen before; words of each language."""
        seen = np.zeros(0, np.uint64)
        total: dict[str, int] = {}
        for words, languages in _batches(batches):
            per_row = np.bincount(words.row, minlength=len(languages))
            for lang, n in zip(languages, per_row.tolist(), strict=True):
                total[lang] = total.get(lang, 0) + n
            fresh = []
            for n, keys, whole in words.keys():
                slot = keys & U(WANTED - 1)
                on = np.flatnonzero(whole & (wanted.value[(slot >> U(3)).astype(np.int64)] >> (slot & U(7)).astype(np.uint8) & 1).astype(bool))
                found, first = np.unique(keys[on], return_index=True)
                unseen = ~np.isin(found, seen, assume_unique=True)
                found, at = found[unseen], on[first[unseen]]
                fresh.append(found)
                if len(found):
                    rows = [languages[r] for r in words.row[at].tolist()]
                    yield batch_of({"key": found.view(np.int64), "lang": rows, "phrase": words.phrase(at, n), "n_words": [n] * len(at), "total": [None] * len(at)}, NAMES)
            seen = np.concatenate([seen if len(seen) < GATHERED else seen[:0], *fresh])
        n = len(total)
        yield batch_of({"key": [None] * n, "lang": list(total), "phrase": [None] * n, "n_words": [None] * n, "total": list(total.values())}, NAMES)

    return name


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("packed"):
            records = unpacked(data.as_buffer())
            yield batch_of({"key": records["key"].view(np.int64), "a": records["n"]}, PAIR)


def _bits(slot: DataFrame, slots: int) -> np.ndarray:
    """The values of the column ``slot`` as packed bits, lowest first: ``slots / 8`` bytes at most come to the driver."""
    counted = slot.select((F.col("slot") + 1).alias("slot"))
    pages = counted.groupBy(F.expr("bitmap_bucket_number(slot)").alias("page")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
    on = np.zeros(-(-slots // 32_768) * 4096, np.uint8)
    for page, bits in pages.collect():  # pages of 32,768 slots count from one
        on[4096 * (page - 1) : 4096 * page] = np.frombuffer(bytes(bits), np.uint8)
    return on


def _named(dealt: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, n_words, a`` for ``key, a``, and the words of each language.

    A frequent phrase is almost surely in a sixteenth of the documents, so few are left to look for in the others; every
    document is read once.
    """
    spark, found, totals, left = dealt.sparkSession, [], [], pairs
    part = F.pmod(F.shiftright(F.xxhash64("text"), 8), F.lit(16))
    for low, high in TURNS:
        table = spark.sparkContext.broadcast(_bits(left.select(F.col("key").bitwiseAND(WANTED - 1).alias("slot")), WANTED))
        some = dealt.where((part >= low) & (part < high)).select("lang", "text")
        names = some.mapInArrow(_namer(table), "key long, lang string, phrase string, n_words int, total long")
        names = checkpoint(names.groupBy("key", "lang", "phrase", "n_words").agg(F.sum("total").alias("total")))
        totals.append(names.where("key IS NULL").select("lang", "total"))
        named = checkpoint(left.join(names.where("key IS NOT NULL").drop("total"), "key", "left"))
        found.append(named.where("phrase IS NOT NULL").select("lang", "phrase", "n_words", "a"))
        left = named.where("phrase IS NULL").select("key", "a")
    every, words = found[0], totals[0]
    for more, other in zip(found[1:], totals[1:], strict=True):
        every, words = every.unionAll(more), words.unionAll(other)
    return checkpoint(every), checkpoint(words.groupBy("lang").agg(F.sum("total").alias("n")))


def frequent_phrases(documents: DataFrame, threshold: int = 100, shards: int = 3, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, n_words, a`` of all phrases of up to five words found ``threshold`` times or more, and ``lang, n``: all words.

    ``slots``: a power of two; the size in bytes of the table that every task gets.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "shards")
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int")).write.partitionBy("shard").option("compression", "zstd").parquet(path)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(path)

    ranges = RANGES * worker_partitions(spark)
    started = np.full(slots, NEVER, np.uint8)
    scan, state, done = 0, None, []
    while scan < shards or ((started != NEVER) & (started >= max(0, scan - shards))).any():
        table = spark.sparkContext.broadcast(started)
        shard = dealt.where(F.col("shard") == scan % shards).select("lang", "text")
        counts = shard.mapInArrow(_counter(table, scan, shards, ranges), "range int, packed binary")
        if state is not None:
            counts = counts.unionByName(state.where(~F.col("frequent")).select("range", "packed"))
        by_range = counts.repartition(worker_partitions(spark), "range").sortWithinPartitions("range")
        state = checkpoint(by_range.mapInArrow(_merger(scan, shards, threshold, slots), "frequent boolean, range int, packed binary, reached array<int>"))
        done.append(state.where("frequent").select("packed"))
        started = started.copy()
        reached = np.unpackbits(_bits(state.select(F.explode("reached").alias("slot")), slots), bitorder="little")[:slots]
        started[reached.astype(bool) & (started == NEVER)] = scan
        scan += 1
    found = done[0]
    for more in done[1:]:
        found = found.unionAll(more)
    return _named(dealt, checkpoint(found.mapInArrow(_pairs, "key long, a long")))


def collocations(documents: DataFrame, threshold: int = 100, top: int = 2_000, covered: int = 100, shards: int = 3, slots: int = SLOTS) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the frequency of the phrase, ``l`` and ``r`` those of its two parts at the cut with the lowest
    ``floor(1000 * a * n / (l * r))``, the least cut on ties. A phrase inside a longer one that has ``covered`` percent
    or more of its frequency is left out. Products are decimals of 38 digits.
    """
    frequent, words = frequent_phrases(documents, threshold, shards, slots)
    long = frequent.where("n_words > 1")
    inner = (
        long.where("n_words > 2")
        .withColumn("w", F.split("phrase", " "))
        .withColumn("inner", F.explode(F.expr("flatten(transform(sequence(2, n_words - 1), m -> transform(sequence(1, n_words - m + 1), i -> array_join(slice(w, i, m), ' '))))")))
        .groupBy("lang", F.col("inner").alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    kept = long.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(covered) * F.col("a")))
    cuts = (
        kept.withColumn("k", F.explode(F.expr("sequence(1, n_words - 1)")))
        .withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    )
    part = frequent.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    cuts = cuts.join(part.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(F.broadcast(words) if words.count() <= 10_000 else words, "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    score = (F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"]).alias("over"), (wide["l"] * wide["r"]).alias("under")
    scored = cuts.select("lang", "phrase", "a", "l", "r", "n", "k", *score).withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.col("best.score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")
