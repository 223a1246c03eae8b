"""Nearest vectors by cosine with a hierarchical navigable small-world graph per shard.

Equal vectors are one point, which bears the smallest ids that can be asked for; points are dealt by hash into shards of
a bounded size. The points of a shard get random levels and stand in falling order of level, so every layer of the
graph is a prefix of the shard and its links are one flat array of a fixed width. Layers are built from the top: many
points at once look for their neighbours in what is built (and among each other), links are chosen so that they
point in different directions, and full link lists are chosen anew. The graph is stored as rows of a table in the shared
folder, each point with its links. Queries search every shard with a beam, many of them in lockstep; what is found is scored in
double precision on the vectors as given, and the shards' results are merged.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors of
different lengths are not compared; rows that repeat an id and its vector are one row; rows that share an id only are
different rows; a row without an id is a candidate that comes last among equals, and no query; an empty table gives no
rows; further columns are left behind.

``SHARD`` bounds the memory of a task, together with ``QUERIES``, the distinct queries that search a shard at once.
Every query has to look into every shard, so the work of the search is queries times shards, in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heightgrid.llm.text import mix
from heightgrid.session import checkpoint, worker_partitions

#: Most and fewest points of a shard on average; as many shards as there are partitions in between.
SHARD, LEAST = 65_536, 4_096
#: Distinct queries in a block.
QUERIES = 16_384
#: Links of a point in upper layers (twice as many in the lowest), beam of the building and of the search.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 80, 128
#: Points or queries that go in lockstep, and beam entries each of them opens at a time.
TOGETHER, OPENED = 256, 4
_LOW = np.float32(-2)


def units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision; scaled by a power of two first, so that no square overflows."""
    _, e = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    v = np.ldexp(vectors, -e[:, None])
    return (v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]).astype(np.float32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        aa, bb, ab = (np.einsum("ij,ij->i", x, y) for x, y in ((a, a), (b, b), (a, b)))
        plain = ab / (np.sqrt(aa) * np.sqrt(bb))
        far = ~(np.isfinite(aa) & np.isfinite(bb) & np.isfinite(ab) & (aa > 1e-280) & (bb > 1e-280))
    if far.any():
        s, t = (np.ldexp(x[far], -np.frexp(np.abs(x[far]).max(axis=1))[1][:, None]) for x in (a, b))
        plain[far] = np.einsum("ij,ij->i", s, t) / (np.sqrt(np.einsum("ij,ij->i", s, s)) * np.sqrt(np.einsum("ij,ij->i", t, t)))
    return plain


def search_layer(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest found of every query, nearest first: numbers (-1 where there are none) and similarities.

    Beam search: as long as a query's beam holds points not yet opened, the nearest of them are, and their links
    enter where they are nearer than what the beam holds. All queries go in lockstep.
    """
    b = len(queries)
    seen = np.zeros((b, len(x)), bool)
    ids = np.full((b, beam), -1, np.int32)
    sims = np.full((b, beam), _LOW, np.float32)
    opened = np.ones((b, beam), bool)
    rows, fresh = np.arange(b), entries
    while True:
        fresh = np.sort(fresh, axis=1)
        good = fresh >= 0
        good[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
        good &= ~seen[rows[:, None], fresh]
        r, c = np.nonzero(good)
        new = fresh[r, c]
        seen[rows[r], new] = True
        near = np.full(fresh.shape, _LOW, np.float32)
        near[r, c] = np.einsum("ij,ij->i", x[new], queries[rows[r]])
        both = np.concatenate([sims[rows], near], axis=1)
        best = np.argsort(-both, axis=1, kind="stable")[:, :beam]
        sims[rows] = np.take_along_axis(both, best, axis=1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], fresh], axis=1), best, axis=1)
        opened[rows] = np.take_along_axis(np.concatenate([opened[rows], ~good], axis=1), best, axis=1)
        rows = np.flatnonzero(~opened.all(axis=1))
        if not len(rows):
            ids[sims <= _LOW] = -1
            return ids, sims
        place = np.argsort(opened[rows], axis=1, kind="stable")[:, :OPENED]
        shut = ~opened[rows[:, None], place]
        opened[rows[:, None], place] = True
        fresh = np.where(shut[:, :, None], links[ids[rows[:, None], place]], -1).reshape(len(rows), -1)


def diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
    """Up to ``width`` links from each row of candidates, nearest first: those nearer to the point than to any link before them, then the rest."""
    out = np.full((len(ids), width), -1, np.int32)
    for a in range(0, len(ids), 1024):
        some, near = ids[a : a + 1024], sims[a : a + 1024]
        points = x[some]
        between = points @ points.transpose(0, 2, 1)
        usable = some >= 0
        kept = np.zeros(some.shape, bool)
        for j in range(some.shape[1]):
            kept[:, j] = usable[:, j] & ~(kept & (between[:, j, :] > near[:, j, None])).any(axis=1)
        order = np.argsort(np.where(kept, 0, np.where(usable, 1, 2)), axis=1, kind="stable")[:, :width]
        chosen = np.where(np.take_along_axis(usable, order, axis=1), np.take_along_axis(some, order, axis=1), -1)
        out[a : a + 1024, : chosen.shape[1]] = chosen
    return out


def _nearest_first(ids: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-sims, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)


def _link_back(x: np.ndarray, links: np.ndarray, first: int, chosen: np.ndarray) -> None:
    """Let the chosen neighbours of the points from ``first`` on link to them; full lists are chosen anew."""
    width = links.shape[1]
    source, place = np.nonzero(chosen >= 0)
    target = chosen[source, place]
    source = (source + first).astype(np.int32)
    near = np.einsum("ij,ij->i", x[source], x[target])
    order = np.lexsort((-near, target))
    source, target = source[order], target[order]
    point, start = np.unique(target, return_index=True)
    turn = np.arange(len(target)) - np.repeat(start, np.diff(np.append(start, len(target))))
    least = turn < width
    coming = np.full((len(point), width), -1, np.int32)
    coming[np.searchsorted(point, target[least]), turn[least]] = source[least]
    for a in range(0, len(point), 1024):
        p = point[a : a + 1024]
        ids = np.concatenate([links[p], coming[a : a + 1024]], axis=1)
        ids = np.sort(ids, axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        sims = np.where(ids >= 0, np.einsum("ijk,ik->ij", x[ids], x[p]), _LOW)
        ids, sims = _nearest_first(ids, sims, 2 * width)
        used = int((ids >= 0).sum(axis=1).max(initial=0))
        links[p] = diverse(x, ids[:, : max(used, 1)], sims[:, : max(used, 1)], width)


def levels(n: int, seed: int) -> np.ndarray:
    """Levels of ``n`` points, falling: geometric with the ratio ``LINKS``."""
    with np.errstate(over="ignore"):
        u = (mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) >> np.uint64(11)).astype(np.float64)
    return np.sort(np.floor(-np.log((u + 1) / (1 << 53)) / np.log(LINKS)).astype(np.int64))[::-1]


def descend(x: np.ndarray, layers: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """Entry points for the layer below ``layers``, which come from the top."""
    entry = np.zeros((len(queries), 1), np.int32)
    for links in layers:
        entry = search_layer(x[: len(links)], links, queries, entry, 4)[0]
    return entry


def build(x: np.ndarray, level: np.ndarray) -> list[np.ndarray]:
    """Links of every layer, from the top; layer ``l`` holds the points before ``(level >= l).sum()``."""
    layers: list[np.ndarray] = []
    for l in range(int(level[0]) if len(level) else -1, -1, -1):
        n = int((level >= l).sum())
        width = LINKS * (1 if l else 2)
        links = np.full((n, width), -1, np.int32)
        for a in range(0, n, TOGETHER):
            b = min(n, a + TOGETHER)
            new = x[a:b]
            peers = new @ new.T
            np.fill_diagonal(peers, _LOW)
            number = np.broadcast_to(np.arange(a, b, dtype=np.int32), peers.shape)
            ids, sims = _nearest_first(np.where(peers > _LOW, number, -1), peers, BUILD_BEAM if a == 0 else LINKS)
            if a:
                entry = descend(x, layers, new)
                found, near = search_layer(x[:a], links[:a], new, np.where(entry < a, entry, 0), BUILD_BEAM)
                ids, sims = _nearest_first(np.concatenate([ids, found], axis=1), np.concatenate([sims, near], axis=1), BUILD_BEAM)
            chosen = diverse(x, ids, sims, LINKS)
            links[a:b, :LINKS] = chosen
            _link_back(x, links, a, chosen)
        layers.append(links)
    return layers


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(n, -1)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.reshape(-1), kind))


def build_shard(points: pa.Table) -> pa.Table:
    """``dim, shard, key, embedding, ids`` of one shard with ``node``, ``level``, ``links`` and ``upper`` (links of the upper layers, lowest first)."""
    points = points.sort_by("key")
    n = points.num_rows
    level = levels(n, points.column("shard")[0].as_py())
    layers = build(units(_matrix(points.column("embedding"), n).astype(np.float64)), level)[::-1]
    upper = [np.concatenate([layers[l][i] for l in range(1, level[i] + 1)]).tolist() if level[i] else [] for i in range(n)]
    made = {"node": pa.array(np.arange(n, dtype=np.int32)), "level": pa.array(level.astype(np.int32)), "links": _lists(layers[0], pa.int32()), "upper": pa.array(upper, pa.list_(pa.int32()))}
    for name, column in made.items():
        points = points.append_column(name, column)
    return points


FOUND = pa.schema([("key", pa.string()), ("vec_id", pa.int64()), ("own", pa.bool_()), ("score", pa.float64())])


def _search_with(k: int):
    def search(points: pa.Table, queries: pa.Table) -> pa.Table:
        """The ``k + 1`` nearest members of a shard for each query, the query's own rows among them."""
        n, m = points.num_rows, queries.num_rows
        if not n or not m:
            return FOUND.empty_table()
        points = points.sort_by("node")
        vectors, asked = (_matrix(t.column("embedding"), c).astype(np.float64) for t, c in ((points, n), (queries, m)))
        x, q = units(vectors), units(asked)
        level = np.asarray(points.column("level").combine_chunks())
        layers = []
        upper = points.column("upper").to_pylist()[: int((level > 0).sum())]
        for l in range(int(level[0]), 0, -1):
            layers.append(np.array([links[LINKS * (l - 1) : LINKS * l] for links in upper[: int((level >= l).sum())]], np.int32))
        lowest = _matrix(points.column("links"), n)
        ids, keys, own_keys = points.column("ids").to_pylist(), queries.column("key").to_pylist(), points.column("key").to_pylist()
        out = []
        for a in range(0, m, TOGETHER):
            some = q[a : a + TOGETHER]
            found, _ = search_layer(x, lowest, some, descend(x, layers, some), max(SEARCH_BEAM, k + 1))
            r, c = np.nonzero(found >= 0)
            node = found[r, c]
            score = cosines(asked[a + r], vectors[node])
            order = np.lexsort((-score, r))
            r, node, score = r[order], node[order], score[order]
            start = np.searchsorted(r, np.arange(len(some) + 1))
            for i in range(len(some)):
                one = slice(start[i], start[i + 1])
                members = []
                for p, s in zip(node[one].tolist(), score[one].tolist(), strict=True):
                    if len(members) > k and s < members[k][1]:
                        break
                    members += [(v, s, own_keys[p] == keys[a + i]) for v in ids[p]]
                    members.sort(key=lambda e: (-e[1], e[0] is None, e[0] or 0))
                out += [(keys[a + i], v, own, s) for v, s, own in members[: k + 1]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), FOUND, strict=True)], schema=FOUND)

    return search


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, embedding, key`` of the vectors that take part, repeated rows once; negative zeros become zeros."""
    kind = embeddings.schema["embedding"].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    good = rows.where("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x != 0)")
    good = good.select("vec_id", F.expr(f"transform(embedding, x -> cast(x + 0 AS {kind}))").alias("embedding"))
    return good.withColumn("key", F.md5(F.col("embedding").cast("string"))).distinct()


def index(rows: DataFrame, k: int) -> DataFrame:
    """The graphs of all shards as a table in the shared folder: one row per different vector, with the ``k + 1`` smallest of its ids."""
    spark = rows.sparkSession
    by_id = Window.partitionBy("key").orderBy(F.col("vec_id").asc_nulls_last())
    few = rows.withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= k + 1)
    points = few.groupBy("key").agg(F.any_value("embedding").alias("embedding"), F.sort_array(F.collect_list(F.struct("at", "vec_id"))).alias("members"))
    points = checkpoint(points.select(F.size("embedding").alias("dim"), "key", "embedding", F.col("members.vec_id").alias("ids")))
    spread = worker_partitions(spark)
    counts = points.groupBy("dim").agg(F.count("*").alias("n"))
    shards = F.greatest(F.ceil(F.col("n") / SHARD), F.least(F.lit(spread), F.ceil(F.col("n") / LEAST)))
    sized = points.join(counts.select(F.col("dim").alias("_dim"), shards.cast("int").alias("shards")), F.col("dim") == F.col("_dim")).drop("_dim")
    dealt = sized.withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int"))
    kind = points.schema["embedding"].dataType.simpleString()
    schema = f"dim int, key string, embedding {kind}, ids array<bigint>, shards int, shard int, node int, level int, links array<int>, upper array<int>"
    return checkpoint(dealt.repartition(4 * spread, "dim", "shard").groupBy("dim", "shard").applyInArrow(build_shard, schema))


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row whose id is divisible by ``every``, ties to smaller ids."""
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    graph = index(rows, k)
    asking = checkpoint(rows.where(F.col("vec_id") % every == 0))
    asked = asking.groupBy("key").agg(F.any_value("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))
    blocks = max(1, -(-asking.count() // QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
    shards = graph.select(F.col("dim").alias("in_dim"), F.col("shard").alias("in_shard")).distinct()
    questions = asked.join(shards, F.col("dim") == F.col("in_dim")).select("in_dim", "in_shard", F.col("block").alias("in_block"), "key", "embedding")
    points = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    by, spread = ("dim", "shard", "block"), 4 * worker_partitions(spark)
    found = (
        points.repartition(spread, *by).groupBy(*by).cogroup(questions.repartition(spread, *(f"in_{c}" for c in by)).groupBy(*(f"in_{c}" for c in by)))
        .applyInArrow(_search_with(k), "key string, vec_id long, own boolean, score double")
    )
    order = (F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    merged = checkpoint(found.withColumn("at", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("at") <= k + 1).drop("at"))
    answers = asking.select(F.col("vec_id").alias("query_id"), "key").join(merged, "key").where(~(F.col("own") & F.col("vec_id").eqNullSafe(F.col("query_id"))))
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "key").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
