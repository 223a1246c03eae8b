"""Nearest vectors, phrases and conversation repair against plain versions, and their defined results on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from heightgrid.llm import catalog, conversations, neighbours, phrases

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- op11


def cosine(a, b):
    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))


def brute_nearest(rows, k, every):
    """Rows: different ``(vec_id, vector)`` that take part."""
    out = {}
    for i, (q, v) in enumerate(rows):
        if q is None or q % every:
            continue
        near = [(-cosine(v, w), c is None, c) for j, (c, w) in enumerate(rows) if j != i and len(w) == len(v)]
        out[q, i] = [(c, -s) for s, _, c in sorted(near, key=lambda e: (round(e[0], 12), e[1], e[2] or 0))[:k]]
    return out


def test_nearest_recall_and_scores(spark):
    rows = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    got = defaultdict(list)
    for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").transform(lambda d: neighbours.nearest(d, 5, 50)).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    vectors = dict(rows)
    hits = total = 0
    for (q, _), want in brute_nearest(rows, 5, 50).items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and all(abs(s - cosine(vectors[q], vectors[c])) < 1e-12 for _, c, s in found)
        hits += len({c for c, _ in want} & {c for _, c, _ in found})
        total += len(want)
    assert len(got) == sum(q % 50 == 0 for q in vectors) and hits / total >= 0.97


def test_nearest_in_several_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAST", 60)
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    got = {(r.query_id, r["rank"]): r.vec_id for r in catalog.op11_small_world(spark, SF).collect()}
    want = {(q, i + 1): c for (q, _), near in brute_nearest(rows, 5, 50).items() for i, (c, _) in enumerate(near)}
    assert got.keys() == want.keys() and sum(got[e] == want[e] for e in want) >= 0.97 * len(want)


def test_nearest_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    many = [(1000 + i, [1.0, 2.0, 3.0]) for i in range(40)]
    rows = [
        (0, [1.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.0]), (50, [0.0, 1.0, 0.0]), (50, [0.5, 1.0, 0.0]), (7, [1e200, 1e200, -0.0]), (8, [1e200, 1e200, 0.0]), (None, [1.0, 1.0, 0.0]),
        (100, None), (150, [0.0, -0.0, 0.0]), (200, [1.0, None, 0.0]), (250, [1.0, nan, 0.0]), (300, [inf, 0.0, 0.0]), (350, []), (400, [1.0, 2.0]), (1, [3.0, 1.0]), *many,
    ]
    schema = "vec_id long, embedding array<double>, rank int, key string, score string"
    df = spark.createDataFrame([(i, v, 9, "clash", "clash") for i, v in rows], schema)
    valid = [(i, v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    valid = [e for j, e in enumerate(valid) if e not in valid[:j]]
    shrunk = [(i, [x / 1e200 for x in v] if max(v) > 1e100 else v) for i, v in valid]
    got = defaultdict(list)
    for r in neighbours.nearest(df, 5, 50).collect():
        got[r.query_id].append((r["rank"], r.vec_id, round(r.score, 12)))
    want = defaultdict(list)
    for (q, _), near in brute_nearest(shrunk, 5, 50).items():
        want[q] += [(i + 1, c, round(s, 12)) for i, (c, s) in enumerate(near)]
    key = lambda e: (e[0], e[1] is None, e[1] or 0, e[2])
    assert got.keys() == want.keys() and all(sorted(got[q], key=key) == sorted(want[q], key=key) for q in want)
    assert neighbours.nearest(df.limit(0)).count() == 0


# --- op12


def brute_phrases(docs, threshold, top, covered=100):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, 6):
                counts[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if a >= threshold and len(p) > 1}
        inside = Counter()
        for p, a in good.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inside[p[i : i + n]] = max(inside[p[i : i + n]], a)
        rows = []
        for p, a in good.items():
            if p in inside and 100 * inside[p] >= covered * a:
                continue
            score, k = min((1000 * a * words[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, words[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


@pytest.mark.parametrize(("threshold", "shards", "slots"), [(100, 3, 1 << 22), (8, 3, 1 << 22), (8, 2, 64), (8, 5, 1 << 12)])
def test_phrases_against_plain_counts(spark, threshold, shards, slots):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(tuple(r) for r in phrases.collocations(docs, threshold, 50, shards=shards, slots=slots).collect())
    assert got == brute_phrases([(r.lang, r.text) for r in docs.collect()], threshold, 50)


def test_phrases_odd_rows(spark):
    long = "on and on and on; the same again! " * 30_000
    rows = [(1, None, "A b, a b\ta  b. é È a b"), (1, None, "A b, a b\ta  b. é È a b"), (2, "en", None), (3, "", ""), (None, "en", long), (5, "en", "x y z w v u\x0bx y z w v u\rx y z w v u"), (6, None, "\x1ca　b \x1ca　b q")]
    df = spark.createDataFrame([(d, lang, t, 1, "clash", 2) for d, lang, t in rows], "doc_id long, lang string, text string, n int, phrase string, score int")
    for covered in (100, 60):
        got = sorted(tuple(r) for r in phrases.collocations(df, 2, 100, covered=covered, slots=1 << 10).collect())
        assert got == brute_phrases([(lang, t) for _, lang, t in rows], 2, 100, covered)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_scores_pass_64_bits(spark, monkeypatch):
    frequent = spark.createDataFrame([("en", "a b", 2, 3_000_000_000), ("en", "a", 1, 7_000_000_000), ("en", "b", 1, 9_000_000_001)], "lang string, phrase string, n_words int, a long")
    words = spark.createDataFrame([("en", 90_000_000_000_007)], "lang string, n long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a: (frequent, words))
    assert phrases.collocations(frequent).collect()[0].score == 1000 * 3_000_000_000 * 90_000_000_000_007 // (7_000_000_000 * 9_000_000_001)


# --- op13


def brute_audit(symbols):
    """Least ``(cost, audit)`` over all edits, by dynamic programming on whole strings; symbols are ``(initial, state)`` or None."""
    far = (10**9, "")
    goes = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]

    def inserted(best):
        for _ in range(3):
            best = [min(x, (best[g["u" if "u" in g else "a"]][0] + 3, "I" + best[g["u" if "u" in g else "a"]][1])) for x, g in zip(best, goes, strict=True)]
        return best

    best = inserted([(0, ""), far, far, (0, "")])
    for symbol in reversed(symbols):
        ways = []
        for q in range(4):
            here = [(best[q][0] + 4, "D" + best[q][1])]
            if symbol is not None:
                initial, cut = symbol
                for to, letter, cost in [(initial, "K", 0), ("u", "R", 3), ("a", "R", 3)]:
                    if to in goes[q]:
                        after = best[goes[q][to]]
                        here.append((after[0] + cost + 3 * cut, letter + after[1]))
            ways.append(min(here))
        best = inserted(ways)
    return best[0]


def brute_repair(rows):
    """``rows``: conv_id, turn, role, text as they are in the table."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        group = groups[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        group += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, group in groups.items():
        group.sort(key=lambda e: (e[0] is not None, e[0] or 0, e[1].encode(), hashlib.md5(e[2].encode()).digest()))
        turns = {t for t, _, _ in group if t is not None}
        seen, symbols, count = set(), [], Counter()
        for _, role, text in group:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            symbols.append(None if fault in ("blank", "duplicate") else (role[:1] or "-", fault == "truncated"))
        initials = [r[:1] for _, r, _ in group]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials))
        cost, audit = brute_audit(symbols)
        lines, at, initial = [], 0, ""
        for letter in audit:
            owed = "assistant" if initial == "u" else "user"
            if letter == "I":
                lines.append(f"{owed}:")
            else:
                _, role, text = group[at]
                at += 1
                if letter == "D":
                    continue
                lines.append(f"{role if letter == 'K' else owed}:{text}")
            initial = lines[-1][0]
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_block_tables_find_the_least_audit():
    symbols = [*((i, cut) for i in "sua?" for cut in (False, True)), None]
    for n in range(4):
        for some in itertools.product(range(9), repeat=n):
            assert conversations.cheapest(bytes(some)) == brute_audit([symbols[s] for s in some])
    draw = random.Random(5)
    for _ in range(1500):
        some = [draw.randrange(9) for _ in range(draw.randrange(40))]
        assert conversations.cheapest(bytes(some)) == brute_audit([symbols[s] for s in some])


def test_repair_of_the_table(spark):
    rows = duckdb.sql("SELECT conv_id, turn, role, text FROM '/root/testdata/sf0.1/conversations.parquet'").fetchall()
    df = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    assert {r.conv_id: tuple(r)[1:] for r in conversations.repair(conversations.damage(df)).collect()} == brute_repair(rows)


def test_repair_odd_rows(spark):
    draw = random.Random(9)
    texts = [None, "", " \t\x0b", "yes.", "No", "¿qué? ", "日本語。", "end!\n", "x" * 200_000 + "?", "a:b\nuser:c."]
    roles = [None, "", "user", "assistant", "system", "tool", "User"]
    rows = [(draw.choice([None, 1, 2, 3, -4]), draw.choice([None, *range(-2, 9)]), draw.choice(roles), draw.choice(texts)) for _ in range(150)]
    rows += [(c, t, draw.choice(["user", "assistant"]), f"{t}.") for c in range(100, 160) for t in range(draw.randrange(1, 6))]
    rows += [(7, t, "user", "again.") for t in range(3000)] + rows[:20] + [(8, None, "user", "No turn."), (8, None, "assistant", "None.")]
    df = spark.createDataFrame([(*r, 1, "clash", True) for r in rows], "conv_id long, turn long, role string, text string, copies int, mark string, first boolean")
    assert {r.conv_id: tuple(r)[1:] for r in conversations.repair(conversations.damage(df)).collect()} == brute_repair(rows)
    assert conversations.repair(conversations.damage(df.limit(0))).count() == 0


def test_repair_without_damage(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "More?"), (2, 0, "system", "Be kind.")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.cost, r.audit) for r in conversations.repair(conversations.undamaged(df)).collect()}
    assert got == {1: (3, "KKIK"), 2: (4, "D")}
