"""Personal data in whole texts: fixed patterns first, then spans that a character tagger adds.

The tagger reads overlapping windows of WINDOW places, STEP apart. Runs of one label are candidate spans; candidates of
one kind that overlap, as those cut by a window's edge do, are joined, and of all candidates of a text the
non-overlapping set with the largest sum of confidence times length is taken. Each kind needs some content (an @, or so many
digits), so a window without a digit or @ decodes to no span under any weights and is not run.
Spans that overlap a pattern's span, or stay under CONFIDENCE, are not added.

Null text is empty; repeated rows are each reported; empty tables give no rows; offsets are code points.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tagger import _CLASS, KINDS, Tagger, classes_of, trained

WINDOW = 128
STEP = 64
CONFIDENCE = 0.95
WINDOWS_AT_ONCE = 512

COLUMNS = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)

Span = tuple[int, int, int]  # start, end, index of the kind: sorts as reported

_TRIGGER = re.compile("[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile("[^0-9]+")
_LOCAL_BYTES = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind, in linear time, sorted by start and kind."""
    found: list[Span] = []
    last = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL_BYTES:
            start -= 1
        if start < m.start():
            found.append((start, m.end(), 0))
            last = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def _has_content(value: str, kind: int) -> bool:
    if kind == 0:
        return "@" in value
    return len(_NO_DIGIT.sub("", value)) >= (4, 13, 7)[kind - 1]


def reconciled(candidates: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Join overlapping candidates (start, end, kind, confidence) of a kind, then the best non-overlapping set."""
    joined: list[list] = []
    for start, end, kind, p in sorted(candidates, key=lambda c: (c[2], c[0], c[1])):
        if joined and joined[-1][2] == kind and start < joined[-1][1]:
            joined[-1][1], joined[-1][3] = max(joined[-1][1], end), max(joined[-1][3], p)
        else:
            joined.append([start, end, kind, p])
    joined.sort(key=lambda c: (c[1], c[0], c[2]))
    ends = [c[1] for c in joined]
    best, take = [0.0], []
    for k, (start, end, _, p) in enumerate(joined):
        before = bisect_right(ends, start, 0, k)
        gain = best[before] + p * (end - start)
        take.append(before if gain > best[k] else -1)
        best.append(max(gain, best[k]))
    out, k = [], len(joined)
    while k:
        if take[k - 1] < 0:
            k -= 1
        else:
            out.append(tuple(joined[k - 1]))
            k = take[k - 1]
    return out[::-1]


def tagged(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, int, float]]]:
    """The tagger's reconciled spans of each text."""
    found: list[list] = [[] for _ in texts]
    places: list[tuple[int, int, int]] = []
    rows: list[np.ndarray] = []

    def run() -> None:
        path, p = tagger.decode(np.array(rows))
        for (text, low, size), labels, sure in zip(places, path, p):
            if not labels.any():
                continue
            cut = np.flatnonzero(np.diff(labels[:size])) + 1
            for a, b in zip(np.r_[0, cut], np.r_[cut, size]):
                if labels[a]:
                    found[text].append((low + int(a), low + int(b), int(labels[a]) - 1, float(sure[a:b].mean())))
        places.clear()
        rows.clear()

    for k, text in enumerate(texts):
        if not _TRIGGER.search(text):
            continue
        x = classes_of(text)
        trigger = np.flatnonzero((x == _CLASS[48]) | (x == _CLASS[64]))
        for low in range(0, max(1, len(x) - STEP), STEP):
            a = np.searchsorted(trigger, low)
            if a < len(trigger) and trigger[a] < low + WINDOW:
                part = x[low : low + WINDOW]
                rows.append(np.r_[part, np.full(WINDOW - len(part), _CLASS[10])])
                places.append((k, low, len(part)))
                if len(rows) == WINDOWS_AT_ONCE:
                    run()
    if rows:
        run()
    return [
        reconciled([c for c in spans if _has_content(text[c[0] : c[1]], c[2])]) for text, spans in zip(texts, found)
    ]


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """(pattern spans, all spans) of each text, in reported order."""
    out = []
    for text, extra in zip(texts, tagged(texts, tagger)):
        base = pattern_spans(text) if _TRIGGER.search(text) else []
        added = []
        for start, end, kind, p in extra:
            value = text[start:end]
            start, end = start + len(value) - len(value.lstrip(" \n")), end - len(value) + len(value.rstrip(" \n.,"))
            if p >= CONFIDENCE and all(end <= b[0] or start >= b[1] for b in base):
                added.append((start, end, kind))
        out.append((base, sorted([*base, *added], key=lambda s: (s[0], s[2]))))
    return out


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, end, k in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document (see COLUMNS); the counts and base_sha256 are those of the patterns."""
    tagger = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                found = all_spans([t or "" for t in part.column(1).to_pylist()], tagger.value)
                counts = [pa.array([sum(s[2] == k for s in base) for base, _ in found], pa.int64()) for k in range(4)]
                digest = [sha256(written_out(base).encode()).hexdigest() for base, _ in found]
                spans = [written_out(every) for _, every in found]
                added = pa.array([len(every) - len(base) for base, every in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *counts, pa.array(digest), pa.array(spans), added],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, COLUMNS)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, last = [], 0
    for start, end, kind in spans:
        if start >= last:
            out += [text[last:start], f"[{KINDS[kind].upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def mask_documents(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked; n_chars follows, other columns stay, null text stays null."""
    tagger = docs.sparkSession.sparkContext.broadcast(trained())
    names = docs.columns
    at, length = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                texts = part.column(at).to_pylist()
                found = all_spans([t or "" for t in texts], tagger.value)
                texts = [t if t is None else masked(t, every) for t, (_, every) in zip(texts, found)]
                columns = list(part.columns)
                columns[at] = pa.array(texts, pa.string())
                if length is not None:
                    given = part.column(length)
                    new = [n if t is None else len(t) for t, n in zip(texts, given.to_pylist())]
                    columns[length] = pa.array(new, given.type)
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
