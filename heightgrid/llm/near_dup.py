"""Near-duplicate documents by MinHash, with odd sketches that check banded candidates before the exact comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heightgrid.llm.text import U, batch_of, chunks, find_words, mix, plain_documents, rolled, span_hashes, text_bytes, tidy
from heightgrid.operators.zones import smallest_labels
from heightgrid.session import checkpoint, worker_partitions

WORDS = 5
BANDS, ROWS = 24, 5
SKETCH_BITS = 512
#: Pairs whose estimate lies further than this below the wanted similarity are not compared: about six standard errors.
SLACK = 0.2
#: Members of one bucket that a task compares with another such block at a time.
BLOCK = 512
#: Ids up to this number (16 MB) are broadcast.
BROADCAST_IDS = 2_000_000

_rng = np.random.Generator(np.random.PCG64(20240607))
_A = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * U(2) + U(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_SEED = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct 5-word shingles as 64-bit hashes; a shorter text is one shingle, an empty one has none."""
    return np.unique(rolled(words, min(WORDS, len(words)))) if len(words) else np.zeros(0, np.uint64)


def minhashes(shingles: np.ndarray) -> np.ndarray:
    best = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 1024):
        best = np.minimum(best, (shingles[None, a : a + 1024] * _A[:, None] + _B[:, None]).min(axis=1))
    return best


def odd_sketch(mins: np.ndarray) -> np.ndarray:
    """Each (sample number, value) flips one bit: the parity bitmap of the sampled set, as signed 64-bit words."""
    bit = mix(mins ^ _SEED) % U(SKETCH_BITS)
    flips = np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def band_keys(mins: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        keys = mix(keys * U(0x9E3779B97F4A7C15) + mins[r::ROWS])
    return keys.view(np.int64)


def estimated_similarity(differing_bits, k: int = BANDS * ROWS, n: int = SKETCH_BITS):
    """Jaccard similarity from the population count of two odd sketches' XOR."""
    full = 1 - 2 * np.minimum(np.asarray(differing_bits, float), n / 2 - 0.5) / n
    return 1 + n / (4 * k) * np.log(full)


def most_differing_bits(similarity: float) -> int:
    """The greatest XOR population count of pairs that are still compared exactly."""
    return int(np.flatnonzero(estimated_similarity(np.arange(SKETCH_BITS // 2)) >= similarity - SLACK).max())


_SIGNED = "set_lo long, set_hi long, n_shingles long, bands array<long>, sketch array<long>"


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, set hash, set size, band keys and odd sketch of every row; rows without words have empty bands."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("set_lo", pa.int64()), ("set_hi", pa.int64()), ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in _shingle_sets(batch.column(1)):
                out: dict[str, list] = {n: [] for n in schema.names}
                for s in sets:
                    mins = minhashes(s)
                    lo, hi = (int(x) for x in np.array([mix(s).sum(dtype=np.uint64), mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)]).view(np.int64))
                    for name, v in zip(schema.names[1:], (lo, hi, len(s), band_keys(mins) if len(s) else [], odd_sketch(mins)), strict=True):
                        out[name].append(v)
                yield batch_of(out | {"doc_id": batch.column(0).slice(at, len(sets))}, schema)

    return plain_documents(docs).mapInArrow(tidy(run), f"doc_id long, {_SIGNED}")


def _shingle_sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    data, offsets = text_bytes(column)
    for a, b in chunks(offsets):
        part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = find_words(part, own)
        words = span_hashes(part, starts, ends, lower=True)
        yield a, [shingle_set(words[first[i] : first[i + 1]]) for i in range(b - a)]


def differing_bits(a: str, b: str) -> Column:
    """Population count of the XOR of two sketches, on the JVM."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, v: s + v)


def near_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids``: the ids are broadcast if their counted number allows it, else joined by key."""
    ids = checkpoint(ids.distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose full shingle sets have ``100 * intersection >= percent * union``.

    Only texts of candidates are shuffled. A hub that many pairs share is a skewed join key, which adaptive execution
    splits. Of a repeated id every text is compared.
    """
    needed = near_ids(texts, pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))))
    left = needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = pa.chunked_array([batch.column(2), batch.column(3)]).combine_chunks().dictionary_encode()
            sets = [s for _, some in _shingle_sets(coded.dictionary) for s in some]
            place = coded.indices.to_numpy(zero_copy_only=False)
            good = []
            for i in range(batch.num_rows):
                if _similar(sets[place[i]], sets[place[batch.num_rows + i]], percent):
                    good.append(i)
            at = pa.array(good, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], schema=schema)

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(tidy(run), "a long, b long")


def _similar(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
        return False
    both = len(np.intersect1d(s, t, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(s) + len(t) - both)


def _links_across(part: dict[str, np.ndarray], limit: int, percent: int) -> list[tuple[int, int]]:
    """Links that join different components within one pair of blocks.

    Pairs come by the nearness of their sketches. A pair that has become connected is passed over, and so is one that
    shares an earlier band, where it has its turn; the rest is compared on full sets.
    """
    ids, label, band = part["doc_id"], part["component"].copy(), int(part["band"][0])
    rows, cols = np.flatnonzero(part["own"] == part["x"]), np.flatnonzero(part["own"] == part["y"])
    same = part["x"][0] == part["y"][0]
    sets: dict[int, np.ndarray] = {}
    links = []

    def full(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = next(_shingle_sets(pa.array([part["text"][i]])))[1][0]
        return sets[i]

    for r in rows:
        other = cols[label[cols] != label[r]]
        if same:
            other = other[ids[other] < ids[r]]
        differ = np.bitwise_count(part["bits"][other] ^ part["bits"][r]).sum(axis=1)
        near = (differ <= limit) & ~(part["bands"][other, :band] == part["bands"][r, :band]).any(axis=1)
        other = other[near][np.argsort(differ[near], kind="stable")]
        for c in other.tolist():
            if label[c] != label[r] and _similar(full(r), full(c), percent):
                links.append((int(min(ids[r], ids[c])), int(max(ids[r], ids[c]))))
                label[label == label[c]] = label[r]
    return links


def _across(members: DataFrame, limit: int, percent: int) -> DataFrame:
    """Links between different components inside buckets, found block by block.

    A bucket's members are dealt to blocks by a hash; a row goes to each pair of blocks it belongs to, so a task holds
    two blocks of about ``BLOCK`` rows at a time and a bucket of n members makes n * n / BLOCK rows, not n * n. Pairs
    never become rows: only links come out, at most one for each two components of a pair of blocks.
    """
    spread = members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int")
    dealt = members.join(spread, ["band", "key"]).withColumn("own", F.pmod(F.xxhash64("doc_id", "band"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    group = ["band", "key", "x", "y"]
    kept = ("doc_id", "component", "sketch", "bands", "text")
    spread_out = (
        dealt.select("band", "key", "own", *kept, other)
        .select("band", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", *kept)
        .repartition(worker_partitions(members.sparkSession), *group)
        .sortWithinPartitions(*group)
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in _and_end(batches):
            now: dict[str, np.ndarray] = {}
            if batch is not None and batch.num_rows:
                now = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in (*group, "own", "doc_id", "component", "text")}
                for name, column in (("bits", "sketch"), ("bands", "bands")):
                    now[name] = batch.column(column).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(batch.num_rows, -1)
            if held:
                now = {n: np.concatenate([v, now[n]]) for n, v in held.items()} if now else held
            if not now:
                continue
            change = np.zeros(len(now["own"]) - 1, bool)
            for n in group:
                change |= now[n][1:] != now[n][:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
            if batch is None:
                cuts.append(len(now["own"]))
            held = {n: v[cuts[-1] :] for n, v in now.items()}
            links = [x for i, j in zip(cuts[:-1], cuts[1:], strict=True) for x in _links_across({n: v[i:j] for n, v in now.items()}, limit, percent)]
            if links:
                a, b = zip(*links, strict=True)
                yield batch_of({"a": a, "b": b}, schema)

    return spread_out.mapInArrow(tidy(run), "a long, b long")


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes of a link table but the smallest of each component."""
    found = smallest_labels(links.select(F.lit(0).alias("all"), "a", "b"), "all")
    return found.select(F.col("label").alias("node"), F.col("root").alias("component"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row: near-duplicates share the smallest id of their group.

    1. Rows with equal shingle sets fall into one class, whose smallest id stands for it.
    2. In each bucket every class is compared with the smallest member; the links give first components.
    3. Buckets that still hold several components are compared across them, in blocks.
    Candidates pass the odd sketch on the way to the comparison of full sets, and links are confirmed only there.
    A pair at the limit shares no band with probability 1e-6 at 85 percent and 7e-5 at 80 (24 bands of 5 samples).

    Null or empty texts have no set and stand alone. Repeated rows are one class; an id repeated with other texts is
    judged by each text. A null id is never linked and is kept, with a null component. An empty table gives an empty
    one; other columns are not read. Ties go to the smallest id.
    """
    signed = checkpoint(signatures(docs))
    limit = most_differing_bits(percent / 100)
    named = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    by_set = ["set_lo", "set_hi", "n_shingles"]
    classes = checkpoint(named.groupBy(*by_set).agg(F.min("doc_id").alias("doc_id")))
    reps = checkpoint(named.join(classes, ["doc_id", *by_set], "left_semi").dropDuplicates(["doc_id", *by_set]).select("doc_id", "bands", "sketch"))
    banded = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    hubs = banded.groupBy("band", "key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last").select("band", "key", "hub")
    shared = checkpoint(banded.join(hubs, ["band", "key"]))
    sketches = reps.select("doc_id", "sketch")
    stars = shared.where("doc_id > hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    near = checkpoint(
        stars.join(sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sa")), "a")
        .join(sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sb")), "b")
        .where(differing_bits("sa", "sb") <= limit)
        .select("a", "b")
        .distinct()
    )
    texts = plain_documents(docs)
    links = checkpoint(confirmed(near, texts, percent).distinct())
    first = _components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("part"))
    in_parts = checkpoint(
        shared.join(first, "doc_id", "left").select("band", "key", "doc_id", F.coalesce("part", "doc_id").alias("component"))
    )
    mixed = in_parts.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("band", "key")
    members = in_parts.join(mixed, ["band", "key"]).join(reps, "doc_id")
    members = checkpoint(members.select("band", "key", "doc_id", "component", "sketch", "bands"))
    members = members.join(near_ids(texts, members.select("doc_id")), "doc_id")
    final = _components(links.union(_across(members, limit, percent)).distinct())
    label = final.select(F.col("node").alias("doc_id"), F.col("component").alias("part"))
    classes = classes.join(label, "doc_id", "left").select(*by_set, F.coalesce("part", "doc_id").alias("class_component"))
    alone = F.coalesce("class_component", "doc_id")
    return signed.select("doc_id", *by_set).join(classes, by_set, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), alone).alias("component_id"), F.coalesce(alone == F.col("doc_id"), F.lit(True)).alias("kept")
    )
