"""Conversation structure repair by block tables in the manner of the Four Russians.

A conversation has good structure when the initials of its roles read ``(s?(ua)+)?``. Each row is kept (0), given the
role user or assistant (3) or deleted (4); empty rows of user or assistant may be inserted anywhere (3); blank rows and
duplicates must go, and a truncated row that stays adds 3. ``repair`` finds the cheapest edits.

Read from the end, a conversation is a string of symbols that turns one vector of costs into the next: the cheapest
way to an accepted end from each of the four states (nothing yet, after s, after u, after a). Less its smallest entry
the vector takes a few values only, so the outcome of every block of four symbols on every such vector is in one
table, made once from the rules. A conversation takes one lookup for four rows; the vectors between blocks are kept,
and going forward each block is expanded backward from the vector behind it. Since all costs to the end are known,
the least letter that keeps to the cheapest cost is always the right one.

Defined results. Null roles and texts, and a null number in the damage key, count as one space. Rows of one turn stand by role,
then by the MD5 of the text; rows that repeat exactly are duplicates of their first. A role without a first letter
cannot be kept. A null ``conv_id`` is one conversation. A conversation of which damage leaves nothing has zeros and the
hash of an empty string; an empty table gives no rows. Further columns are left behind.

What a task holds of a conversation is one byte a row, which is the size of its ``audit``; texts pass by in order and
are hashed as they come, because SHA-256 is a chain. Which rows are duplicates is found by counts that combine before
they are dealt out, and by a join that Spark can split, so a text that is repeated without end is no group of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heightgrid.llm.text import batch_of
from heightgrid.session import checkpoint, worker_partitions

WHITE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Symbols in a block of the table.
BLOCK = 4
#: States: nothing yet, after s, after u, after a. What a kept role leads to; states that may end.
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ENDS = (0, 3)
#: What an inserted row, or a row given another role, has to be in each state.
OWED = ["user", "user", "assistant", "user"]
#: Symbols: role s, u, a or another, each whole or truncated; a row that must go; none (fills the last block).
ROLES = "sua?"
KINDS = {"s": 0, "u": 1, "a": 2}
GONE, NONE = 8, 9
BLANK, WHOLE, CUT = range(3)

ANSWER = pa.schema([("conv_id", pa.int64())] + [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])
_SQL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
FINAL = ANSWER.append(pa.field("repaired_sha256", pa.string()))


def _insertions(costs: list[int]) -> tuple[int, ...]:
    """Costs when rows may first be inserted; two of them lead back to the same kind of state."""
    costs = list(costs)
    for _ in range(2):
        costs = [min(c, INSERT + costs[2 if OWED[q] == "user" else 3]) for q, c in enumerate(costs)]
    return tuple(costs)


@cache
def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end from each state in front of a row, given those behind it."""
    if symbol == NONE:
        return after
    if symbol == GONE:
        return _insertions([DELETE + c for c in after])
    role, extra = ROLES[symbol // 2], TRUNCATED * (symbol % 2)
    costs = []
    for q in range(4):
        ways = [DELETE + after[q], REROLE + extra + after[2 if OWED[q] == "user" else 3]]
        if role in NEXT[q]:
            ways.append(extra + after[NEXT[q][role]])
        costs.append(min(ways))
    return _insertions(costs)


def _less(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    low = min(costs)
    return tuple(c - low for c in costs), low


END = _insertions([0 if q in ENDS else 1 << 20 for q in range(4)])


@cache
def block_table() -> tuple[list[tuple[int, ...]], dict[bytes, list[tuple[int, int]]]]:
    """All vectors that can come up, and for each block of symbols what it makes of each of them: its number and the cost taken off."""
    vectors = [_less(END)[0]]
    number = {vectors[0]: 0}
    single: list[list[tuple[int, int]]] = []
    for v in vectors:  # grows on the way
        row = []
        for symbol in range(NONE + 1):
            w, low = _less(_before(symbol, v))
            if w not in number:
                number[w] = len(vectors)
                vectors.append(w)
            row.append((number[w], low))
        single.append(row)
    table = {b"": [(k, 0) for k in range(len(vectors))]}
    for size in range(1, BLOCK + 1):
        for block in product(range(NONE + 1), repeat=size):
            rest = table[bytes(block[1:])]
            table[bytes(block)] = [(single[k][block[0]][0], low + single[k][block[0]][1]) for k, low in rest]
    return vectors, {b: t for b, t in table.items() if len(b) == BLOCK}


def cheapest(symbols: bytes) -> tuple[int, str]:
    """Cost and ASCII-least audit of the cheapest edits."""
    vectors, table = block_table()
    n = len(symbols)
    padded = symbols + bytes([NONE]) * (-n % BLOCK)
    blocks = len(padded) // BLOCK
    behind, spent = bytearray(blocks), _less(END)[1]
    k = 0
    for b in range(blocks - 1, -1, -1):
        behind[b] = k
        k, low = table[padded[BLOCK * b : BLOCK * b + BLOCK]][k]
        spent += low
    cost = spent + vectors[k][0]
    audit, q, now = [], 0, vectors[k]
    for b in range(blocks):
        block = padded[BLOCK * b : BLOCK * b + BLOCK]
        costs = [vectors[behind[b]]]
        for symbol in reversed(block):
            costs.append(_before(symbol, costs[-1]))
        costs.reverse()
        for j, symbol in enumerate(block):
            if symbol != NONE:
                q = _step(symbol, q, costs[j], costs[j + 1], audit)
    _close(q, audit)
    return cost, "".join(audit)


def _step(symbol: int, q: int, here: tuple[int, ...], after: tuple[int, ...], audit: list[str]) -> int:
    """One row going forward: the least letter that keeps to the cheapest cost, insertions in front of it included."""
    while True:
        left = here[q]
        if left == DELETE + after[q]:
            audit.append("D")
            return q
        owed = 2 if OWED[q] == "user" else 3
        if left == INSERT + here[owed]:
            audit.append("I")
            q = owed
            continue
        role, extra = ROLES[symbol // 2], TRUNCATED * (symbol % 2)
        if role in NEXT[q] and left == extra + after[NEXT[q][role]]:
            audit.append("K")
            return NEXT[q][role]
        audit.append("R")
        return owed


def _close(q: int, audit: list[str]) -> None:
    """Rows owed at the end."""
    while q not in ENDS:
        audit.append("I")
        q = 2 if OWED[q] == "user" else 3


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: the damaged rows; a dropped row has no copies and only its conversation."""
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("kind"),
    )
    kind = F.col("kind")
    return rows.select(
        "conv_id", F.when(kind != 0, F.col("turn")).alias("turn"),
        F.when(kind == 0, F.lit("")).when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind <= 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def undamaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of the rows as they are."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.lit(1).cast("long").alias("copies"))


def _mark() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _ordered(rows: DataFrame, *order: str) -> DataFrame:
    """Whole conversations in one partition, in order, nulls first."""
    return rows.repartition(worker_partitions(rows.sparkSession), "conv_id").sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in ("conv_id", *order)))


def _symbols(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, mark, initial, state, again, copies``: every distinct row without its text, and if a like one stands before it."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    state = F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), WHOLE).otherwise(CUT)
    narrow = rows.select("conv_id", "turn", "role", _mark().alias("mark"), state.alias("state"), "copies")
    narrow = narrow.groupBy("conv_id", "turn", "role", "mark", "state").agg(F.sum("copies").alias("copies"))
    narrow = checkpoint(narrow)
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn"), F.lit(0)).alias("turn"))
    firsts = narrow.where((F.col("copies") > 0) & (F.col("state") != BLANK)).groupBy("conv_id", "role", "mark").agg(F.min(turn).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("mark").alias("_mark"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("mark") == F.col("_mark"))
    return narrow.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "mark", F.left("role", F.lit(1)).alias("initial"), "state", F.coalesce(turn > F.col("first"), F.lit(False)).alias("again"), "copies"
    )


class _Counts:
    """What is counted of one conversation while its rows pass."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.symbols = conv_id, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None

    def add(self, turn: int | None, initial: str, state: int, again: bool, copies: int) -> None:
        if not copies:
            return
        if turn is not None and turn != self.high:  # turns ascend
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        inner = copies - 1 if initial + initial not in ("su", "ua", "au") else 0
        self.illegal += inner + (self.last is not None and self.last + initial not in ("su", "ua", "au"))
        self.last = initial
        if state == BLANK or again:
            self.blank += copies if state == BLANK else 0
            self.duplicate += copies if state != BLANK else 0
            self.symbols += bytes([GONE]) * copies
            return
        self.truncated += state == CUT
        self.duplicate += copies - 1
        self.symbols.append(2 * KINDS.get(initial, 3) + (state == CUT))
        self.symbols += bytes([GONE]) * (copies - 1)

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit = cheapest(bytes(self.symbols))
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its rows in order."""
    now, out = None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "initial", "state", "again", "copies")]
        for conv_id, *row in zip(*columns, strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    out.append(now.row())
                now = _Counts(conv_id)
            now.add(*row)
        if sum(len(r[-1]) for r in out) + len(out) > 100_000:
            yield batch_of(dict(zip(ANSWER.names, zip(*out, strict=True), strict=True)), ANSWER)
            out = []
    if now is not None:
        out.append(now.row())
    if out:
        yield batch_of(dict(zip(ANSWER.names, zip(*out, strict=True), strict=True)), ANSWER)


class _Repaired:
    """Walks the audit of one conversation along its rows and hashes what comes out."""

    def __init__(self, facts: tuple):
        self.facts, self.audit, self.at, self.q = facts, facts[-1], 0, 0
        self.digest, self.lines = hashlib.sha256(), 0

    def line(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.line(OWED[self.q], "")
            self.q = 2 if OWED[self.q] == "user" else 3
            self.at += 1

    def add(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self.inserted()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.line(role, text)
                self.q = NEXT[self.q][role[0]]
            elif letter == "R":
                self.line(OWED[self.q], text)
                self.q = 2 if OWED[self.q] == "user" else 3

    def row(self) -> tuple:
        self.inserted()
        return *self.facts, self.digest.hexdigest()


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations with the hash of their repaired rows; a conversation's facts come before its rows."""
    now, out = None, []
    for batch in batches:
        facts = [batch.column(n).to_pylist() for n in ANSWER.names]
        rows = [batch.column(n).to_pylist() for n in ("first", "role", "text", "copies")]
        for fact, (first, role, text, copies) in zip(zip(*facts, strict=True), zip(*rows, strict=True), strict=True):
            if first:
                if now is not None:
                    out.append(now.row())
                now = _Repaired(fact)
            else:
                now.add(role, text, copies)
        if sum(len(r[-2]) for r in out) + len(out) > 100_000:
            yield batch_of(dict(zip(FINAL.names, zip(*out, strict=True), strict=True)), FINAL)
            out = []
    if now is not None:
        out.append(now.row())
    if out:
        yield batch_of(dict(zip(FINAL.names, zip(*out, strict=True), strict=True)), FINAL)


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest repair and the hash of the repaired conversation, one row per ``conv_id``.

    ``rows`` come from ``damage`` or ``undamaged``: ``conv_id, turn, role, text, copies``.
    """
    narrow = _ordered(_symbols(rows), "turn", "role", "mark").select("conv_id", "turn", "initial", "state", "again", "copies")
    facts = checkpoint(narrow.mapInArrow(_audit, _SQL))
    empty = {n: F.lit(None).cast("long") for n in ("turn", "copies")} | {n: F.lit(None).cast("string") for n in ("role", "text")} | {"mark": F.lit(None).cast("binary")}
    head = facts.withColumns(empty | {"first": F.lit(True)})
    counts = {n: F.lit(None).cast("long") for n in ANSWER.names[1:-1]} | {"audit": F.lit(None).cast("string")}
    body = rows.where("copies > 0").withColumns(counts | {"mark": _mark(), "first": F.lit(False)})
    both = head.unionByName(body).withColumn("after", ~F.col("first"))
    names = [*ANSWER.names, "first", "role", "text", "copies"]
    return _ordered(both, "after", "turn", "role", "mark").select(*names).mapInArrow(_hash, _SQL + ", repaired_sha256 string")
