"""Removal of every byte inside a 100-byte string that also starts earlier in the corpus.

Routing. Among the 85 GRAM-byte grams of a 100-byte window, the one with the smallest hash (the rightmost of equals) is
the window's anchor. Equal windows have equal anchors at the same place, so an anchor's windows, which are neighbours and form a
slice of text, need only be compared with slices of the same anchor. Anchors seen once are done. Slices
with the same bytes are one class, whose later members are removed whole; that is the pre-aggregation of copies.

Sorting. The first slice of each class goes, with all slices of its anchor, to one task, which builds the suffix array of its
slices in two stages: suffixes smaller than their successor are sorted directly, to the depth that matters, and the
others are induced by scanning the buckets in order. Adjacent common prefixes of 100 bytes make classes of equal
windows; all but the earliest window of a class are removed. Anchors with more than HOT distinct slices are
not gathered: their windows are dealt out by content and the earliest is found by a pre-aggregated minimum.

Null text has no bytes. A doc_id names one text: rows that repeat it are in the same place, never remove each other's bytes, and
are each reported. Rows without a doc_id come before all others, ordered by a hash of their texts, so that different texts are
different documents and equal ones repeat a document. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import RangeHash, row_slices, utf8
from .store import dropped, written

LENGTH = 100
GRAM = 16
GRAMS = LENGTH - GRAM + 1
HOT = 20_000
TASK_BYTES = 4 << 20
#: Rows without a doc_id get ids below -2^62 from their text; given ids are above.
UNNAMED_BITS = (1 << 61) - 1

_PLACE_BITS = 21
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
SLICES = "doc_id long, anchor long, slice long, start long, windows int, lead int"


def slices_of_text(data: np.ndarray, offsets: np.ndarray):
    """(row, anchor, slice, start in row, windows, lead) of every anchor of a few rows, as arrays.

    `start` is the first window's, `lead` the anchor's distance from it.
    """
    parts = []
    n = len(data) - LENGTH + 1
    room = np.zeros(max(n, 0), bool)
    for low, high in zip(offsets[:-1], offsets[1:]):
        room[low : max(low, high - LENGTH + 1)] = True
    hashed = RangeHash(data) if n > 0 else None
    step = 1 << (_PLACE_BITS - 1)
    for first in range(0, n, step):
        count = min(step, n - first)
        at = np.arange(first, first + count + GRAMS - 1)
        place = (at - first).astype(np.uint64)
        least = (hashed(at, at + GRAM) & ~_PLACE) | (_PLACE - place)
        reach = 1
        while reach * 2 <= GRAMS:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        least = np.minimum(least[:count], least[GRAMS - reach : GRAMS - reach + count])
        anchor = first + (_PLACE - (least & _PLACE)).astype(np.int64)
        p = first + np.flatnonzero(room[first : first + count])
        parts.append((p, anchor[p - first]))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    p, anchor = (np.concatenate(c) for c in zip(*parts))
    row = np.searchsorted(offsets, p, "right") - 1
    fresh = np.ones(len(p), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(fresh)
    windows = np.diff(np.r_[head, len(p)])
    p, anchor, row = p[head], anchor[head], row[head]
    lead = anchor - p
    key = hashed(anchor, anchor + GRAM).view(np.int64)
    # The place of the anchor counts as content: equal slices are equal around the same anchor.
    content = (hashed(p, p + windows + LENGTH - 1) + lead.astype(np.uint64)).view(np.int64)
    return row, key, content, p - offsets[row], windows, lead


def text_slices(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for low, high in row_slices(offsets):
                part = offsets[low : high + 1]
                row, key, content, start, windows, lead = slices_of_text(data[part[0] : part[-1]], part - part[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row + low)),
                        *map(pa.array, (key, content, start, windows.astype(np.int32), lead.astype(np.int32))),
                    ],
                    ["doc_id", "anchor", "slice", "start", "windows", "lead"],
                )

    return docs.mapInArrow(run, SLICES)


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Order of all suffixes by at least their first `depth` bytes, in two stages."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    # A suffix is smaller than its successor if the next different byte is larger.
    sign = np.sign(np.diff(text.astype(np.int16)))
    turn = np.where(sign != 0, np.arange(n - 1), n)
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    smaller = np.r_[np.where(turn < n, sign[np.minimum(turn, n - 2)] > 0, False), False]
    # Stage one: sort these directly, eight bytes at a time, only where still tied.
    padded = np.r_[text, np.zeros(depth + 16, np.uint8)]
    eight = np.zeros(n + depth + 8, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + len(eight)].astype(np.uint64)
    direct = np.flatnonzero(smaller)
    direct = direct[np.argsort(eight[direct], kind="stable")]
    key = eight[direct]
    slots = np.arange(len(direct))
    group = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], slots, 0)) if len(direct) else slots
    for deep in range(8, depth, 8):
        if not len(slots):
            break
        fresh = np.r_[True, group[1:] != group[:-1]]
        tied = ~(fresh & np.r_[fresh[1:], True])
        slots, group = slots[tied], group[tied]
        if not len(slots):
            break
        p = direct[slots]
        key = eight[p + deep]
        order = np.lexsort((key, group))
        p, key = p[order], key[order]
        direct[slots] = p
        fresh = np.r_[True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])]
        group = np.maximum.accumulate(np.where(fresh, slots, 0))
    # Stage two: scan the buckets; each suffix places its larger predecessor at the end of that one's bucket.
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    cuts = np.searchsorted(text[direct], np.arange(257))
    out = []

    def send(found: np.ndarray, own: int) -> np.ndarray:
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        first = text[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        edges = np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(first) else []
        stay = before[:0]
        for a, b in zip(edges, [*edges[1:], len(first)]):
            if first[a] == own:
                stay = before[a:b]
            else:
                waiting[first[a]].append(before[a:b])
        return stay

    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else direct[:0]
        while len(wave):
            out.append(wave)
            wave = send(wave, c)
        mine = direct[cuts[c] : cuts[c + 1]]
        if len(mine):
            out.append(mine)
            send(mine, c)
    return np.concatenate(out)


def same_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether the common prefix of suffixes a[i] and b[i] has at least `length` bytes."""
    padded = np.r_[text, np.zeros(8, np.uint8)]
    eight = np.zeros(len(text), np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + len(text)].astype(np.uint64)
    same = np.arange(len(a))
    for k in [*range(0, length - 8, 8), length - 8]:
        same = same[eight[a[same] + k] == eight[b[same] + k]]
    out = np.zeros(len(a), bool)
    out[same] = True
    return out


def later_windows(frame: pd.DataFrame) -> pd.DataFrame:
    """Spans (doc_id, first, last) of the windows of a frame of slices that equal an earlier one."""
    text = np.frombuffer(b"".join(frame["bytes"]), np.uint8)
    windows = frame["windows"].to_numpy(np.int64)
    base = np.r_[0, np.cumsum(windows + LENGTH - 1)]
    owned = np.zeros(len(text), bool)
    which = np.repeat(np.arange(len(frame)), windows)
    inner = np.arange(len(which)) - np.repeat(np.r_[0, np.cumsum(windows)[:-1]], windows)
    at = base[which] + inner
    owned[at] = True
    of = np.zeros(len(text), np.int64)
    of[at] = which
    order = suffix_array(text)
    order = order[owned[order]]
    same = same_prefix(text, order[:-1], order[1:])
    group = np.r_[0, np.cumsum(~same)]
    row = of[order]
    doc = frame["doc_id"].to_numpy(np.int64)[row]
    start = frame["start"].to_numpy(np.int64)[row] + order - base[row]
    by = np.lexsort((start, doc, group))
    g, d, s = group[by], doc[by], start[by]
    head = np.maximum.accumulate(np.where(np.r_[True, g[1:] != g[:-1]], np.arange(len(g)), 0))
    later = (d != d[head]) | (s != s[head])
    d, s = d[later], s[later]
    by = np.lexsort((s, d))
    d, s = d[by], s[by]
    fresh = np.ones(len(d), bool)
    fresh[1:] = (d[1:] != d[:-1]) | (s[1:] > s[:-1] + 1)
    head = np.flatnonzero(fresh)
    tail = np.r_[head[1:], len(d)] - 1
    return pd.DataFrame({"doc_id": d[head], "first": s[head], "last": s[tail[: len(head)]] + LENGTH})


def sorted_slices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole anchors of a partition sorted by anchor, about TASK_BYTES at a time."""
    held: list[pd.DataFrame] = []
    size = 0
    for frame in frames:
        while len(frame):
            size += sum(map(len, frame["bytes"]))
            held.append(frame)
            frame = frame.iloc[:0]
            if size >= TASK_BYTES:
                every = pd.concat(held, ignore_index=True)
                edge = int(np.searchsorted(every["anchor"].to_numpy(), every["anchor"].iloc[-1]))
                if edge:
                    yield later_windows(every.iloc[:edge])
                    every = every.iloc[edge:]
                held, size = [every], sum(map(len, every["bytes"]))
    if held:
        yield later_windows(pd.concat(held, ignore_index=True))


def slice_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted slices (doc_id, anchor, start, windows, hot), read from their documents."""
    listed = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "start", "windows", "hot")).alias("wanted"))
    kind = "doc_id long, anchor long, start long, windows int, hot boolean, bytes binary"
    return docs.join(listed, "doc_id").select("doc_id", "text", "wanted").mapInArrow(cut_out, kind)


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "anchor", "start", "windows", "hot", "bytes"]
    for batch in batches:
        wanted = batch.column(2)
        rows = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy())
        flat = wanted.flatten()
        columns = [flat.field(k) for k in range(4)]
        for low in range(0, len(rows), 20_000):
            part = slice(low, low + 20_000)
            out, last, raw = [], -1, b""
            for row, start, windows in zip(rows[part], columns[1][part].to_pylist(), columns[2][part].to_pylist()):
                if row != last:
                    last, raw = row, batch.column(1)[int(row)].as_py().encode()
                out.append(raw[start : start + windows + LENGTH - 1])
            ids = batch.column(0).take(pa.array(rows[part]))
            yield pa.RecordBatch.from_arrays([ids, *(c[part] for c in columns), pa.array(out, pa.binary())], names)


def hot_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        frame = batch.to_pandas()
        for doc, start, windows, raw in zip(frame["doc_id"], frame["start"], frame["windows"], frame["bytes"]):
            at = np.arange(windows)
            h = RangeHash(np.frombuffer(raw, np.uint8))(at, at + LENGTH).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(windows, doc)), pa.array(start + at), pa.array(h)], ["doc_id", "first", "content"]
            )


def kept_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, first, last in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
            raw = (text or "").encode()
            digest, removed, spans, at = sha256(), 0, 0, 0
            for a, b in sorted(zip(first or [], last or [])):
                if a > at or (a == 0 and spans == 0):
                    digest.update(raw[at:a])
                    spans += 1
                    removed += b - a
                    at = b
                elif b > at:
                    removed += b - at
                    at = b
            digest.update(raw[at:])
            out.append((len(raw), removed, spans, digest.hexdigest()))
        columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if out:
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    unnamed = F.xxhash64("text").bitwiseAND(UNNAMED_BITS) - F.lit(1 << 62) - F.lit(1 << 62)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("doc_id"), "text")
    every = written(text_slices(docs))
    shared = every.groupBy("anchor").count().where("count > 1").select("anchor")
    some = written(every.join(shared, "anchor"))
    dropped(every)
    place = F.struct("doc_id", "start")
    firsts = some.groupBy("anchor", "slice").agg(F.min(place).alias("place"), F.first("windows").alias("windows"))
    firsts = written(firsts.select("anchor", "slice", F.col("place.doc_id").alias("doc_id"), F.col("place.start").alias("start"), "windows"))
    known = firsts.select("anchor", "slice", F.col("doc_id").alias("d"), F.col("start").alias("s"))
    copies = some.join(known, ["anchor", "slice"]).where("doc_id <> d OR start <> s")
    copies = copies.select("doc_id", F.col("start").alias("first"), (F.col("start") + F.col("windows") + LENGTH - 1).alias("last"))
    copies = written(copies)
    dropped(some)

    several = firsts.groupBy("anchor").count().where("count > 1")
    several = several.select("anchor", (F.col("count") > HOT).alias("hot"))
    texts = written(slice_bytes(docs, firsts.join(several, "anchor")))
    fan = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spans = "doc_id long, first long, last long"
    usual = texts.where("NOT hot").select("doc_id", "anchor", "start", "windows", "bytes")
    usual = usual.repartition(fan, "anchor").sortWithinPartitions("anchor").mapInPandas(sorted_slices, spans)
    dealt = texts.where("hot").select("doc_id", "start", "windows", "bytes")
    dealt = dealt.mapInArrow(hot_windows, "doc_id long, first long, content long")
    least = dealt.groupBy("content").agg(F.min(F.struct("doc_id", "first")).alias("place"))
    hot = dealt.join(least, "content").where("doc_id <> place.doc_id OR first <> place.first")
    hot = hot.select("doc_id", "first", (F.col("first") + LENGTH).alias("last"))
    spans = copies.unionByName(usual).unionByName(hot)
    spans = spans.groupBy("doc_id").agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))
    spans = written(spans)
    dropped(firsts, copies, texts)
    out = docs.join(spans, "doc_id", "left").select("doc_id", "text", "first", "last")
    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return out.mapInArrow(kept_text, kind).withColumn("doc_id", F.when(F.col("doc_id") >= -(1 << 62), F.col("doc_id")))
