"""Benchmark decontamination by winnowing.

A window is SPAN consecutive words of a benchmark item. Of every SPAN - K + 1 consecutive K-gram hashes
the smallest (the rightmost of equals) is kept, in documents and items alike, so each shared window shares a
kept K-gram at the same place. Kept K-grams are joined and each match is extended word by word up to a
window's length on both sides; runs of SPAN words or more are hit. Items of fewer than SPAN
words are matched whole: for each such length L, every L-gram is kept (K = L, one hash per window).

The documents' fingerprints are thinned before the join with a bit table of fixed size that holds all
benchmark fingerprints; a benchmark so large that it fills the table only makes the join larger.

Null text has no words. Repeated rows are each reported; rows that share doc_id but not text are
reported apart. Null item ids count in no list. Empty tables give no rows, or no hits. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import ALNUM, U64, RangeHash, Words, find_words, row_slices, utf8, windows
from .store import written

SPAN = 10
K = 5
SIDE = SPAN - K
BITS = 1 << 24
WHOLE = -1  # length code of the row that reports a text's word count

ROWS = "id long, uid long, length int, print long, at long, context binary"


def winnow(words: Words) -> np.ndarray:
    """Places in the K-gram arrays of the kept K-grams."""
    at, h = windows(words, K)
    n = len(at) - SIDE
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(n)
    for j in range(1, SIDE + 1):
        here = np.arange(j, n + j)
        best = np.where(h[here] <= h[best], here, best)
    whole = at[SIDE:] - at[:n] == SIDE
    whole &= words.row[at[:n]] == words.row[at[SIDE:]]
    return np.unique(best[whole])


def fingerprints(data: np.ndarray, offsets: np.ndarray, lengths: list[int], bits: np.ndarray | None):
    """(words, [(length, row, word place in its row, print, context)]) of a slice of rows."""
    words = find_words(data, offsets, ALNUM, lower=True)
    at, h = windows(words, K)
    kept = winnow(words)
    found = []
    at, h = at[kept], h[kept]
    if bits is not None:
        ok = passes(bits, h)
        at, h = at[ok], h[ok]
    padded = np.r_[np.zeros(SIDE, U64), words.hash, np.zeros(SPAN, U64)]
    place = at[:, None] + np.arange(-SIDE, SPAN)
    low, high = words.bounds[words.row[at]][:, None], words.bounds[words.row[at] + 1][:, None]
    context = np.where((place >= low) & (place < high), padded[place + SIDE], U64(0))
    found.append((0, words.row[at], at - low[:, 0], h, context))
    n = np.diff(words.bounds)
    for length in lengths:
        at, h = windows(words, length)
        ok = n[words.row[at]] == length if bits is None else passes(bits, h)
        at, h = at[ok], h[ok]
        row = words.row[at]
        found.append((length, row, at - words.bounds[row], h, np.zeros((len(at), 0), U64)))
    return words, found


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    cell = bit_of(h)
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1


def bit_of(h: np.ndarray) -> np.ndarray:
    return (h % U64(BITS)).astype(np.int64)


def prints(texts: DataFrame, id_column: str, lengths: list[int], bits=None) -> DataFrame:
    """ROWS of every text: one with its word count, and one for each fingerprint that passes `bits`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0)
            for low, high in row_slices(offsets):
                part = offsets[low : high + 1]
                piece, part = data[part[0] : part[-1]], part - part[0]
                uid = RangeHash(piece)(part[:-1], part[1:]).view(np.int64)
                words, found = fingerprints(piece, part, lengths, None if bits is None else bits.value)
                n = np.diff(words.bounds)
                none = np.zeros(high - low, U64)
                found.append((WHOLE, np.arange(high - low), n, none, np.zeros((high - low, 0), U64)))
                for length, row, at, h, context in found:
                    width = context.shape[1] * 8
                    raw = np.ascontiguousarray(context).tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(row + low)),
                            pa.array(uid[row]),
                            pa.array(np.full(len(row), length, np.int32)),
                            pa.array(h.view(np.int64)),
                            pa.array(at.astype(np.int64)),
                            pa.array([raw[i * width : (i + 1) * width] for i in range(len(row))], pa.binary()),
                        ],
                        ["id", "uid", "length", "print", "at", "context"],
                    )

    return texts.select(F.col(id_column).cast("long"), "text").mapInArrow(run, ROWS)


def bit_table(keys: DataFrame) -> np.ndarray:
    """BITS bits, set at every print; at most BITS numbers come to the driver."""
    cells = keys.select(F.pmod(F.col("print").cast("decimal(20,0)"), F.lit(BITS)).cast("int").alias("c")).distinct()
    cells = cells.toPandas()["c"].to_numpy(np.int64)
    bits = np.zeros(BITS, np.uint8)
    bits[cells] = 1
    return np.packbits(bits, bitorder="little")


def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches as word spans: whole short items, or runs of SPAN words and more around a shared K-gram."""
    names = ["id", "uid", "first", "last", "length", "print", "window"]
    for batch in batches:
        length = batch.column(2).to_numpy()
        at = batch.column(4).to_numpy()
        first, last = at.copy(), at + length
        long = np.flatnonzero(length == 0)
        ok = length > 0
        if len(long):
            mine, theirs = (
                np.frombuffer(b"".join(batch.column(c).take(pa.array(long)).to_pylist()), U64).reshape(-1, SPAN + SIDE)
                for c in (5, 7)
            )
            same = (mine == theirs) & (mine != 0)
            before = np.minimum.accumulate(same[:, :SIDE][:, ::-1], axis=1).sum(1)
            after = np.minimum.accumulate(same[:, SIDE + K :], axis=1).sum(1)
            first[long] = at[long] - before
            last[long] = at[long] + K + after
            ok[long] = same[:, SIDE : SIDE + K].all(1) & (before + K + after >= SPAN)
        columns = [batch.column(0), batch.column(1), pa.array(first), pa.array(last)]
        columns += [batch.column(2), batch.column(3), batch.column(6)]
        yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(ok))


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on id and uid, null ids included."""
    right = right.withColumnsRenamed({"id": "right_id", "uid": "right_uid"})
    on = F.col("id").eqNullSafe(F.col("right_id")) & (F.col("uid") == F.col("right_uid"))
    return left.join(right, on, "left").drop("right_id", "right_uid")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    spark = docs.sparkSession
    items = written(prints(benchmark, "item_id", list(range(1, SPAN))))
    keys = items.where(F.col("length") >= 0).withColumn("window", F.xxhash64("context"))
    shapes = keys.select("length", "print", "window", F.col("context").alias("theirs")).distinct()
    lengths = sorted(r[0] for r in keys.where("length > 0").select("length").distinct().collect())  # at most SPAN - 1
    bits = spark.sparkContext.broadcast(bit_table(keys.select("print").distinct()))

    rows = written(prints(docs, "doc_id", lengths, bits))
    texts = rows.where(F.col("length") == WHOLE).select("id", "uid", F.col("at").alias("n_words"))
    marks = rows.where(F.col("length") >= 0).join(shapes, ["length", "print"])
    marks = marks.select("id", "uid", "length", "print", "at", "context", "window", "theirs")
    spans = "id long, uid long, first long, last long, length int, print long, window long"
    spans = written(marks.mapInArrow(extended, spans).distinct())

    order = Window.partitionBy("id", "uid").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("last") - F.greatest("first", F.coalesce(before, F.lit(0))))
    hit = spans.select("id", "uid", "first", "last").distinct().select("id", "uid", new.alias("new"))
    hit = hit.groupBy("id", "uid").agg(F.sum("new").alias("n_hit"))
    # Each distinct window of a document once, then its items, each once.
    shown = spans.select("id", "uid", "length", "print", "window").distinct()
    owners = keys.where("id IS NOT NULL").select("length", "print", "window", F.col("id").alias("item_id")).distinct()
    shown = shown.join(owners, ["length", "print", "window"]).select("id", "uid", "item_id").distinct()
    shown = shown.groupBy("id", "uid").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))

    out = _joined(_joined(texts, hit), shown)
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
