"""Quality rules on repeated text, found by a suffix array over each document's words.

The suffix array of every document is built by prefix doubling (only suffixes that are still tied
are sorted again). Adjacent common prefixes are read off the ranks kept per doubling step. For the
suffix at p, the larger of its two adjacent common prefixes is the longest string starting at p
that occurs again; the union of these spans is the union of all maximal repeated substrings.

Rows are independent: null text counts as empty, repeated rows are each judged, an empty table gives
no rows, other columns are not read. A document without words has zero counts and is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import SPACED, RangeHash, Words, find_words, row_slices, utf8


@dataclass(frozen=True)
class Rules:
    """Limits. `min_repeat` words make a repeat count for the method's verdict."""

    min_words: int = 50
    max_repeat_pct: int = 50
    min_repeat: int = 5
    max_covered: float = 0.3
    max_longest: float = 0.25


COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_fraction double, longest_repeat long"
)

_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[list(b"#*$%&|<>")] = 1
_CODE_POINT = np.array([(b & 0xC0) != 0x80 for b in range(256)], np.int64)


def longest_repeats(words: Words) -> np.ndarray:
    """For each word, the length in words of the longest string starting there that occurs again in its row."""
    n = len(words.row)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    # Ranks of single words within their row; a rank is the first slot of its group of ties.
    _, ids = np.unique(words.hash, return_inverse=True)
    key = words.row * (int(ids.max()) + 1) + ids
    array = np.argsort(key, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    fresh = np.r_[True, np.diff(key[array]) != 0]
    group = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    rank[array] = group
    end = words.bounds[words.row + 1]
    levels, step = [rank.copy()], 1
    slots = np.arange(n)
    while True:
        fresh = np.r_[True, np.diff(group) != 0]
        tied = ~(fresh & np.r_[fresh[1:], True])
        slots, group = slots[tied], group[tied]
        if not len(slots):
            break
        p = array[slots]
        ahead = np.where(p + step < end[p], rank[np.minimum(p + step, n)], -1)
        key = group * (n + 1) + ahead + 1
        order = np.argsort(key, kind="stable")
        key, p = key[order], p[order]
        array[slots] = p
        fresh = np.r_[True, np.diff(key) != 0]
        group = slots[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        rank[p] = group
        levels.append(rank.copy())
        step *= 2
    # Common prefix of neighbours in the array: the longest sum of steps whose ranks agree.
    a, b = array[:-1].copy(), array[1:].copy()
    live = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[live], b[live]
    common = np.zeros(len(live), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        same = levels[level][a] == levels[level][b]
        common[same] += 1 << level
        a[same] += 1 << level
        b[same] += 1 << level
        a, b = np.minimum(a, n), np.minimum(b, n)
    lcp = np.zeros(n + 1, np.int64)
    lcp[live + 1] = common
    out[array] = np.maximum(lcp[:-1], lcp[1:])
    return out


def covered(longest: np.ndarray, at_least: int) -> np.ndarray:
    """Words inside any repeat of at least so many words: the union of the spans."""
    edge = np.zeros(len(longest) + 1, np.int64)
    p = np.flatnonzero(longest >= at_least)
    edge[p] += 1
    np.subtract.at(edge, p + longest[p], 1)
    return np.cumsum(edge[:-1]) > 0


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(values, dtype=np.int64)][bounds])


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same row, per row."""
    cut = np.flatnonzero(data == 0x0A)
    start = np.unique(np.r_[offsets[:-1], cut + 1])
    start = start[start < len(data)]
    if not len(start):
        return np.zeros(len(offsets) - 1, np.int64)
    row = np.searchsorted(offsets, start, "right") - 1
    next_start = np.r_[start[1:], len(data)]
    ends_in_newline = data[next_start - 1] == 0x0A
    end = next_start - ends_in_newline
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, row = start[has_word], end[has_word], row[has_word]
    h = RangeHash(data)(start, end)
    order = np.lexsort((h, row))
    again = (np.diff(row[order]) == 0) & (h[order][1:] == h[order][:-1])
    return np.bincount(row[order][1:][again], minlength=len(offsets) - 1)


def judge(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    words = find_words(data, offsets, SPACED)
    n = np.diff(words.bounds)
    longest = longest_repeats(words)
    repeat = per_row(covered(longest, 3), words.bounds)
    in_long = per_row(covered(longest, rules.min_repeat), words.bounds)
    top = np.zeros(len(n), np.int64)
    np.maximum.at(top, words.row, longest)
    letters = np.r_[0, np.cumsum(_CODE_POINT[data])]
    failed = (n < rules.min_words) | (100 * repeat > rules.max_repeat_pct * n)
    fraction = in_long / np.maximum(n, 1)
    good = (fraction <= rules.max_covered) & (top <= rules.max_longest * n)
    return {
        "n_words": n,
        "word_chars": per_row(letters[words.end] - letters[words.start], words.bounds),
        "n_symbols": per_row(_SYMBOLS[data], offsets),
        "n_dup_lines": duplicate_lines(data, offsets, words),
        "n_repeat_words": repeat,
        "base_failed": failed,
        "kept": ~failed & good,
        "covered_fraction": fraction,
        "longest_repeat": top,
    }


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document with its counts and verdict (see COLUMNS)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for low, high in row_slices(offsets):
                part = offsets[low : high + 1]
                found = judge(data[part[0] : part[-1]], part - part[0], rules)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), *map(pa.array, found.values())], ["doc_id", *found]
                )

    return docs.select("doc_id", "text").mapInArrow(run, COLUMNS)


def good_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            for low, high in row_slices(offsets):
                part = offsets[low : high + 1]
                kept = judge(data[part[0] : part[-1]], part - part[0], rules)["kept"]
                yield batch.slice(low, high - low).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
