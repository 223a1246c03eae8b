"""Quality rules from repetition coverage: characters inside repeated n-grams and repeated lines, by rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, StructField, StructType

from heightgrid.llm.text import CONTINUES, batch_of, chunks, find_words, plain_documents, rolled, span_hashes, text_bytes, tidy

#: The published limits for the share of characters inside n-grams and lines seen earlier in the text.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHARS_LIMIT = 0.20
LINES_LIMIT = 0.30
SYMBOLS_LIMIT = 0.10

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, dup_line_chars long, dup_ngram_chars array<long>"
)


@dataclass(frozen=True)
class Rules:
    """``min_words``, ``repeat_percent``: base rules. The rest: greatest shares of a document's word characters (lines: of lines; symbols: per word)."""

    min_words: int = 50
    repeat_percent: int = 50
    ngrams: dict[int, float] = field(default_factory=lambda: dict(NGRAM_LIMITS))
    line_chars: float = LINE_CHARS_LIMIT
    lines: float = LINES_LIMIT
    symbols: float = SYMBOLS_LIMIT


def _seen_before(h: np.ndarray) -> np.ndarray:
    """Whether an equal value stands earlier."""
    seen = np.ones(len(h), bool)
    seen[np.unique(h, return_index=True)[1]] = False
    return seen


def _in_repeats(h: np.ndarray) -> np.ndarray:
    """Whether a value occurs twice or more."""
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.isin(h, twice) if len(twice) else np.zeros(len(h), bool)


def _covered(at: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside the windows of ``n`` words that begin at ``at``."""
    change = np.zeros(words + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + n, -1)
    return np.cumsum(change)[:-1] > 0


def measure(words: np.ndarray, chars: np.ndarray, ngrams: list[int]) -> tuple[int, list[int]]:
    """Words in repeated 3-word windows, and for each length the characters of words inside n-grams seen earlier.

    A repeated window of n words begins where a repeated window of fewer words begins, so each length looks only at
    the places the length before has left. The first of equal n-grams is not counted: a text loses only its repeats.
    """
    m = len(words)
    h3 = rolled(words, 3)
    at = np.flatnonzero(_in_repeats(h3))
    repeat_words = int(_covered(at, 3, m).sum()) if len(at) else 0
    coverage = []
    for n in sorted(ngrams):
        at = at[at + n <= m]
        h = rolled(words, n)[at]
        again = _in_repeats(h)
        at, h = at[again], h[again]
        coverage.append(int(chars[_covered(at[_seen_before(h)], n, m)].sum()) if len(at) else 0)
    return repeat_words, coverage


def _lines(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends, and word characters of all lines that hold a word, and each row's first line number."""
    breaks = np.flatnonzero(data == 10)
    begins = np.union1d(offsets[:-1], breaks + 1)
    begins = begins[begins < len(data)]
    ends = np.append(begins, len(data))[1:]
    ends = np.where((ends > begins) & (data[ends - 1] == 10), ends - 1, ends)
    w0, w1 = np.searchsorted(starts, begins), np.searchsorted(starts, ends)
    keep = w1 > w0
    total = np.concatenate([[0], np.cumsum(chars)])
    return begins[keep], ends[keep], (total[w1] - total[w0])[keep], np.searchsorted(begins[keep], offsets)


def _chunk(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, list]:
    starts, ends, first = find_words(data, offsets)
    words = span_hashes(data, starts, ends)
    points = np.concatenate([[0], np.cumsum(~CONTINUES[data])])
    chars = points[ends] - points[starts]
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    line_at, line_end, line_chars, first_line = _lines(data, offsets, starts, chars)
    lines = span_hashes(data, line_at, line_end)
    out: dict[str, list] = {name: [] for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "dup_line_chars", "dup_ngram_chars")}
    for i in range(len(offsets) - 1):
        w, c = words[first[i] : first[i + 1]], chars[first[i] : first[i + 1]]
        own = slice(first_line[i], first_line[i + 1])
        again = _seen_before(lines[own])
        repeat_words, coverage = measure(w, c, list(rules.ngrams))
        n, total, dup, dup_chars = len(w), int(c.sum()), int(again.sum()), int(line_chars[own][again].sum())
        failed = n < rules.min_words or 100 * repeat_words > rules.repeat_percent * n
        n_symbols = int(symbols[offsets[i + 1]] - symbols[offsets[i]])
        good = n_symbols <= rules.symbols * n and dup <= rules.lines * len(again) and dup_chars <= rules.line_chars * total
        good = good and all(x <= share * total for x, share in zip(coverage, (rules.ngrams[k] for k in sorted(rules.ngrams)), strict=True))
        row = (n, total, n_symbols, dup, repeat_words, failed, good and not failed, dup_chars, coverage)
        for name, value in zip(out, row, strict=True):
            out[name].append(value)
    return out


def repetition(docs: DataFrame, rules: Rules | None = None, carry: bool = False) -> DataFrame:
    """One row per row of ``docs`` with its counts, coverages and verdict; no shuffle.

    With ``carry`` the rows of ``docs`` come back whole, with ``kept`` as their only new column.

    Null or empty text: no words, so ``base_failed``. Null ids and repeated rows stay as they are; other columns are
    not read; an empty table gives an empty one. Memory follows chunks of 2 MB, or the longest single text.
    """
    rules = rules or Rules()
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("dup_line_chars", pa.int64()), ("dup_ngram_chars", pa.list_(pa.int64()))]
    )

    if carry:
        return _with_verdict(docs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                part = _chunk(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], rules)
                yield batch_of({"doc_id": batch.column(0).slice(a, b - a), **part}, schema)

    return plain_documents(docs).mapInArrow(tidy(run), SCHEMA)


def _with_verdict(docs: DataFrame, rules: Rules) -> DataFrame:
    kept = StructType([*docs.schema.fields, StructField("kept", BooleanType())])
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(place))
            for a, b in chunks(offsets):
                verdicts = _chunk(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], rules)["kept"]
                yield batch.slice(a, b - a).append_column("kept", pa.array(verdicts, pa.bool_()))

    return docs.mapInArrow(tidy(run), kept)
