"""Secret scan: base rules, and a character convolutional network over every other candidate with its context."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heightgrid.llm.text import CONTINUES, LOWER, batch_of, chunks, mix, plain_documents, text_bytes, tidy
from heightgrid.session import checkpoint

#: The base rules in the order of their kinds, and the least length of what must match.
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "network")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_LEAST_VALUE, _LEAST_ACCESS, _LEAST_HEX, _LEAST_CANDIDATE = 12, 18, 16, 12

BEFORE, INSIDE, AFTER = 24, 40, 8
WINDOW = BEFORE + INSIDE + AFTER
#: Distance of a long candidate's windows, and windows made at a time.
STEP, AT_ONCE = INSIDE // 2, 20_000


def _class(text: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(text)] = True
    return table


_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_IN_RUN, _IN_HEX = _class(_LETTERS + _DIGITS + b"+/_.=-"), _class(_DIGITS + b"abcdef")
_IS_DIGIT, _IS_LETTER, _IS_UPPER = _class(_DIGITS), _class(_LETTERS), _class(_LETTERS[:26])


def _runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``least`` bytes or more that do not cross a row."""
    begin, final = mask.copy(), mask.copy()
    begin[1:] &= ~mask[:-1]
    rows = offsets[:-1][offsets[:-1] < len(mask)]
    begin[rows] = mask[rows]
    final[:-1] &= ~mask[1:] | begin[1:]
    a, b = np.flatnonzero(begin), np.flatnonzero(final) + 1
    long = b - a >= least
    return a[long], b[long]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the base rules in code points, sorted."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= _LEAST_VALUE]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= _LEAST_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text) if m.end() - m.start() >= _LEAST_HEX]
    return sorted(found)


def candidates(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of 12 credential characters or more that mix letters with digits, or capitals into the inside."""
    a, b = _runs(_IN_RUN[data], offsets, _LEAST_CANDIDATE)
    good = _mixed(data, a, b)
    return a[good], b[good]


def _mixed(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    count = lambda table: np.concatenate([[0], np.cumsum(table[data])])
    digits, letters, capitals = count(_IS_DIGIT), count(_IS_LETTER), count(_IS_UPPER)
    n_letters, n_capitals = letters[b] - letters[a], capitals[b] - capitals[a + 1]
    return ((digits[b] > digits[a]) & (n_letters > 0)) | ((n_capitals > 0) & (n_letters - 1 > n_capitals))


def windows(data: np.ndarray, row_a: np.ndarray, row_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes around each candidate: 24 before ``a``, the first 40 from there, and 8 behind its end; 0 where a row or the candidate ends."""
    step = np.arange(WINDOW)[None, :]
    at = a[:, None] - BEFORE + step
    behind = b[:, None] + step - BEFORE - INSIDE
    place = np.where(step >= BEFORE + INSIDE, behind, at)
    valid = (place >= row_a[:, None]) & (place < row_b[:, None]) & ~((step >= BEFORE) & (step < BEFORE + INSIDE) & (at >= b[:, None]))
    return np.where(valid, data[np.clip(place, 0, max(len(data) - 1, 0))], 0).astype(np.uint8)


def _scan(data: np.ndarray, offsets: np.ndarray) -> tuple[list[list[tuple[int, int, int]]], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Base spans of each row, and of all candidates: row, byte start and end, start and end in code points, touched by a base span.

    Rows without a key word, the access prefix or a long enough hexadecimal run cannot match and skip the patterns.
    """
    n = len(offsets) - 1
    lower, whole = LOWER[data].tobytes(), data.tobytes()
    base: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    look = {int(i) for i in np.searchsorted(offsets, _runs(_IN_HEX[data], offsets, _LEAST_HEX)[0], "right") - 1}
    for blob, words in ((lower, _WORDS), (whole, (b"AKIA",))):
        for w in words:
            at = blob.find(w)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                look.add(row)
                at = blob.find(w, int(offsets[row + 1]))
    for i in look:
        base[i] = base_spans(whole[offsets[i] : offsets[i + 1]].decode())
    a, b = candidates(data, offsets)
    row = np.searchsorted(offsets, a, "right") - 1
    points = np.concatenate([[0], np.cumsum(~CONTINUES[data])]) if len(a) else np.zeros(len(data) + 1, np.int64)
    pa_, pb_ = points[a] - points[offsets[row]], points[b] - points[offsets[row]]
    touched = np.zeros(len(a), bool)
    for r in {int(r) for r in row if base[r]}:
        low, high = np.searchsorted(row, [r, r + 1])
        starts, reach = _reaches(base[r])
        before = np.searchsorted(starts, pb_[low:high])
        touched[low:high] = (before > 0) & (reach[before - 1] > pa_[low:high])
    return base, row, a, b, np.stack([pa_, pb_]), touched


def _reaches(spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts of a row's spans, in order, and the furthest end up to each of them."""
    return np.array([s for s, _, _ in spans]), np.maximum.accumulate([e for _, e, _ in spans])


@dataclass
class Network:
    """Byte embedding, one convolution, greatest value over all places, a hidden layer, a logistic output; all in numpy."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 2.0
    WIDTH = 5

    @classmethod
    def fresh(cls, seed: int = 7, dims: int = 6, filters: int = 24, hidden: int = 16) -> Network:
        r = np.random.default_rng(seed)
        f = lambda *s: r.normal(0, 1 / np.sqrt(np.prod(s[:-1])), s).astype(np.float32)
        z = lambda n: np.zeros(n, np.float32)
        return cls(r.normal(0, 0.5, (256, dims)).astype(np.float32), f(cls.WIDTH * dims, filters), z(filters), f(filters, hidden), z(hidden), f(hidden, 1), z(1))

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        e = self.embed[x]
        places = x.shape[1] - self.WIDTH + 1
        cols = np.concatenate([e[:, j : j + places] for j in range(self.WIDTH)], axis=2)
        conv = cols @ self.filters + self.bias
        top = conv.argmax(axis=1)
        best = np.take_along_axis(conv, top[:, None, :], 1)[:, 0]
        pooled = np.maximum(best, 0)
        h = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        return cols, top, best, pooled, h, (h @ self.out + self.out_bias)[:, 0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        parts = [self._forward(x[i : i + 512])[-1] for i in range(0, len(x), 512)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(x) / self.temperature))

    def _parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        cols, top, best, pooled, h, logit = self._forward(x)
        d = ((1 / (1 + np.exp(-logit)) - y) * weight / len(y)).astype(np.float32)[:, None]
        dh = (d @ self.out.T) * (h > 0)
        dp = (dh @ self.hidden.T) * (best > 0)
        picked = np.take_along_axis(cols, top[:, :, None], 1)  # row, filter, width x dims
        dfilters = np.einsum("nfc,nf->cf", picked, dp)
        dcols = dp[:, :, None] * self.filters.T[None]
        dembed = np.zeros_like(self.embed)
        places = top[:, :, None] + np.arange(self.WIDTH)
        codes = np.take_along_axis(x[:, None, :].repeat(1, 1), places.reshape(len(x), 1, -1), 2).reshape(-1)
        np.add.at(dembed, codes, dcols.reshape(len(codes), -1))
        return [dembed, dfilters, dp.sum(0), pooled.T @ dh, dh.sum(0), h.T @ d, d.sum(0)]

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int, seed: int = 11, rate: float = 0.004) -> None:
        """Adam on batches that hold both classes in equal weight."""
        r = np.random.default_rng(seed)
        share = y.mean()
        weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self._parameters()]
        for t in range(1, steps + 1):
            pick = r.integers(0, len(x), 128)
            for p, g, (m, v) in zip(self._parameters(), self._gradients(x[pick], y[pick], weight[pick]), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)


def _without_context(x: np.ndarray) -> np.ndarray:
    """The same candidates with their surroundings taken away, so that the network also learns the look of the value."""
    bare = x.copy()
    bare[:, :BEFORE] = 32
    bare[:, BEFORE + INSIDE :] = 32
    return bare


def train(x: np.ndarray, y: np.ndarray, recall: float = 0.95, steps: int = 250) -> Network | None:
    """A network from windows and labels, or none if one of the labels has fewer than 8 examples.

    A quarter is held back. On it the temperature with the least log loss is chosen. A threshold may not go beyond the
    one that still finds ``recall`` of the held-back secrets; below that it lies midway, in logits, to the strongest of
    the other candidates. It may lie below one half.
    """
    if min((y > 0).sum(), (y == 0).sum()) < 8:
        return None
    x, y = np.concatenate([x, _without_context(x)]), np.concatenate([y, y])
    held = np.tile(np.arange(len(y) // 2) % 4 == 3, 2)
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    net = Network.fresh()
    net.fit(x[~held], y[~held], steps)
    check, truth = (x[held], y[held]) if held.any() else (x, y)
    logits = net.logits(check).astype(np.float64)
    loss = lambda t: np.logaddexp(0, np.where(truth > 0, -logits, logits) / t).mean()
    net.temperature = min((0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0), key=loss)
    highest = np.quantile(logits[truth > 0], 1 - recall, method="lower") / net.temperature
    strongest = logits[truth == 0].max() / net.temperature
    middle = (highest + strongest) / 2 if strongest < highest else highest
    net.threshold = float(1 / (1 + np.exp(1e-5 - middle)))  # a little lower: logits of other batches are rounded otherwise
    return net


def probabilities(network: Network, data: np.ndarray, row_a: np.ndarray, row_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The greatest probability over windows that begin every 20 bytes of a candidate and reach its end."""
    n = np.maximum(-(-(b - a - INSIDE) // STEP), 0) + 1
    first = np.cumsum(n) - n
    best = np.zeros(len(a))
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(first, first[i] + AT_ONCE)))
        which = np.repeat(np.arange(i, j), n[i:j])
        start = a[which] + STEP * (np.arange(len(which)) + first[i] - first[which])
        start = np.maximum(np.minimum(start, b[which] - INSIDE), a[which])
        p = [network.probability(windows(data, row_a[w], row_b[w], start[k : k + AT_ONCE], b[w])) for k in range(0, len(which), AT_ONCE) for w in [which[k : k + AT_ONCE]]]
        best[i:j] = np.maximum.reduceat(np.concatenate(p), first[i:j] - first[i])
        i = j
    return best


def network_spans(network: Network | None, data: np.ndarray, offsets: np.ndarray, scanned: tuple) -> Iterator[tuple[int, int, int]]:
    """Row, start and end in code points of what the network finds in the candidates and, where a base span covers only
    a part of one, in its other parts that are candidates by themselves."""
    base, row, a, b, points, touched = scanned
    if network is None or not len(a):
        return
    parts, known = [], (-1, None, None)
    for k in np.flatnonzero(touched):
        at, end = (int(x) for x in points[:, k])
        if known[0] != row[k]:
            known = (row[k], *_reaches(base[row[k]]))
        first, last = np.searchsorted(known[2], at, "right"), np.searchsorted(known[1], end)
        for s, e, _ in [*base[row[k]][first:last], (end, end, 0)]:
            if min(s, end) - at >= _LEAST_CANDIDATE:
                parts.append((k, at - points[0, k], min(s, end) - points[0, k]))
            at = max(at, e)
    of, start, stop = np.array(parts, np.int64).reshape(-1, 3).T
    start, stop = a[of] + start, a[of] + stop
    good = _mixed(data, start, stop) if len(of) else np.zeros(0, bool)
    rest = np.flatnonzero(~touched)
    of, start, stop = (np.concatenate([x, y[good]]) for x, y in ((rest, of), (a[rest], start), (b[rest], stop)))
    p = probabilities(network, data, offsets[row[of]], offsets[row[of] + 1], start, stop)
    for i in np.flatnonzero(p >= network.threshold):
        k = of[i]
        yield int(row[k]), int(points[0, k] + start[i] - a[k]), int(points[0, k] + stop[i] - a[k])


def labelled_windows(docs: DataFrame, per_label: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of up to ``per_label`` findings of the base rules and as many other candidates, picked by a hash of their bytes.

    Labels: 1 where a base rule agrees, 0 otherwise. Equal windows count once. The sample is bounded by ``per_label``.
    """
    schema = pa.schema([("label", pa.int32()), ("pick", pa.int64()), ("window", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = mix(np.arange(1, WINDOW + 1, dtype=np.uint64))
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in chunks(offsets):
                part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                _, row, a, b, _, touched = _scan(part, own)
                w = windows(part, own[row], own[row + 1], a, b)
                pick = mix((w.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)).view(np.int64)
                yield batch_of({"label": touched.astype(np.int32), "pick": pick, "window": [x.tobytes() for x in w]}, schema)

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), "label int, pick long, window binary")
    found = checkpoint(found.dropDuplicates(["label", "pick"]))
    rows = [r for label in (1, 0) for r in found.where(F.col("label") == label).orderBy("pick").limit(per_label).collect()]
    rows.sort(key=lambda r: r.pick)
    x = np.frombuffer(b"".join(bytes(r.window) for r in rows), np.uint8).reshape(len(rows), WINDOW)
    return x, np.array([r.label for r in rows], np.float32)


def fit_network(docs: DataFrame, per_label: int = 2_000, recall: float = 0.95) -> Network | None:
    return train(*labelled_windows(docs, per_label), recall=recall)


def scan(docs: DataFrame, network: Network | None) -> DataFrame:
    """Base counts, the digest of the base spans, all spans, and the spans as ``array<struct<start,end>>``, for each row.

    Null or empty text: no spans. A tie of two kinds at one start keeps the kinds' order. Null ids, repeated rows and
    further columns pass by unread; without a network (too few labelled findings) there are only base spans. No shuffle.
    """
    columns = ("doc_id", "n_assign", "n_access", "n_hex", "n_network", "base_sha256", "spans", "starts", "ends")
    longs = pa.list_(pa.int64())
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [longs] * 2
    schema = pa.schema(list(zip(columns, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in chunks(offsets):
                part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                scanned = _scan(part, own)
                base = scanned[0]
                spans = [list(s) for s in base]
                for k, s, e in network_spans(network, part, own, scanned):
                    spans[k].append((s, e, 3))
                named = [[f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(x, key=lambda v: (v[0], v[2], v[1]))] for x in (*base, *spans)]
                n = j - i
                count = lambda k: [sum(v[2] == k for v in x) for x in spans]
                out = {"doc_id": batch.column(0).slice(i, n), "n_assign": count(0), "n_access": count(1), "n_hex": count(2), "n_network": count(3)}
                out["base_sha256"] = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in named[:n]]
                out["spans"] = [",".join(x) for x in named[n:]]
                out["starts"], out["ends"] = ([[v[e] for v in sorted(x)] for x in spans] for e in (0, 1))
                yield batch_of(out, schema)

    types = ", ".join(f"{c} {t}" for c, t in zip(columns, ["long"] * 5 + ["string"] * 2 + ["array<long>"] * 2, strict=True))
    return plain_documents(docs).mapInArrow(tidy(run), types)


def find_secrets(docs: DataFrame, per_label: int = 2_000, recall: float = 0.95) -> DataFrame:
    """Train on a bounded sample of the table's own findings, then scan every row."""
    return scan(docs, fit_network(docs, per_label, recall))


def _with_texts(batch: pa.RecordBatch, place: int, changed: dict[int, str]) -> pa.RecordBatch:
    """The batch with new texts, and their lengths in ``n_chars`` if it has one."""
    if not changed:
        return batch
    news = [(place, changed)]
    if "n_chars" in batch.schema.names:
        news.append((batch.schema.names.index("n_chars"), {k: len(t) for k, t in changed.items()}))
    for at, new in news:
        values = batch.column(at).to_pylist()
        for k, value in new.items():
            values[k] = value
        batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.column(at).type))
    return batch


def redact(docs: DataFrame, per_label: int = 2_000, recall: float = 0.95, mask: str = "[redacted]") -> DataFrame:
    """The documents with every span replaced by ``mask``; overlapping spans are replaced together.

    All columns stay; ``text`` changes only in rows with spans (a null stays null), ``n_chars`` follows where it exists.
    """
    network = fit_network(docs, per_label, recall)
    schema = docs.schema
    place = schema.fieldNames().index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(place))
            for i, j in chunks(offsets):
                part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                scanned = _scan(part, own)
                spans = [[(s, e) for s, e, _ in x] for x in scanned[0]]
                for k, s, e in network_spans(network, part, own, scanned):
                    spans[k].append((s, e))
                changed = {k: masked(part[own[k] : own[k + 1]].tobytes().decode(), x, mask) for k, x in enumerate(spans) if x}
                yield _with_texts(batch.slice(i, j - i), place, changed)

    return docs.mapInArrow(tidy(run), schema)


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    parts, done = [], 0
    merged: list[list[int]] = []
    for s, e in sorted(spans):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        parts += [text[done:s], mask]
        done = e
    return "".join([*parts, text[done:]])
