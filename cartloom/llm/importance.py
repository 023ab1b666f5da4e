"""Importance resampling of documents towards a target text by bit-sliced weights.

1. The bucket counts of all documents and of the target are summed; BUCKETS numbers each reach the driver, whatever the
   input, and give every bucket a whole-numbered gain.
2. A document's bucket counts become bit planes: plane j holds bit j of every bucket's count, one bit a bucket. The gains
   become planes too, one set for positive and one for negative gains. The weight is the sum over pairs of planes of
   2^(j + k) times the bits set in both, which is exact.
3. Scores are ranked by a range partitioning on (score, doc_id) with one row number per range and the ranges'
   sizes before it; nothing is ordered in one task. Rows alike in both are told apart by their row number.

Features are hashed from their words: the crc of joined words follows from the crcs of the words by the shift
of the first by the length of the second, so no feature is ever built as text.

Null or wordless text has no features and weight 0. Repeated rows are scored, and drawn, apart. A null doc_id
draws as an empty one. An empty table gives no rows; an empty target gains nothing on buckets but their
rarity. Texts count whole; a slice of rows takes memory in proportion to its bytes, or to one longer text. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import ALNUM, Words, find_words, row_slices, utf8
from .store import dropped, written

BUCKETS = 10_000
RUN = 3
ROWS_AT_ONCE = 256
DIRECT = 64  # words up to this many bytes are hashed column by column, and shifts by as much are looked up

_LANES = -(-BUCKETS // 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _byte_table() -> np.ndarray:
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = np.where(state & 1, (state >> 1) ^ np.uint32(0xEDB88320), state >> 1).astype(np.uint32)
    return state


_CRC = _byte_table()


def _over(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map, given by its values for each byte of x."""
    return table[0][x & 255] ^ table[1][(x >> 8) & 255] ^ table[2][(x >> 16) & 255] ^ table[3][x >> 24]


def _shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """Maps of a crc to itself n zero bytes later: for n = 0 to DIRECT, and for the powers of two."""
    each = np.arange(256, dtype=np.uint32)
    step = [np.stack([each << np.uint32(8 * i) for i in range(4)])]
    for _ in range(DIRECT):
        last = step[-1]
        step.append(_CRC[last & 255] ^ (last >> np.uint32(8)))
    doubling = [step[1]]
    while len(doubling) < 40:
        doubling.append(_over(doubling[-1], doubling[-1]))
    return np.stack(step), np.stack(doubling)


_STEP, _DOUBLING = _shift_tables()


def shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    near = np.minimum(n, DIRECT)
    out = _STEP[near, 0, crc & 255] ^ _STEP[near, 1, (crc >> 8) & 255] ^ _STEP[near, 2, (crc >> 16) & 255] ^ _STEP[near, 3, crc >> 24]
    far = np.flatnonzero(n > DIRECT)
    if len(far):
        x, left = crc[far], n[far]
        for k in range(int(left.max()).bit_length()):
            x = np.where((left >> k) & 1, _over(_DOUBLING[k], x), x)
        out[far] = x
    return out


def word_crcs(data: np.ndarray, words: Words) -> np.ndarray:
    """crc32 of each word's bytes; `data` is lower-cased."""
    n = words.end - words.start
    order = np.argsort(-np.minimum(n, DIRECT + 1), kind="stable")
    size, start = n[order], words.start[order]
    long = int(np.searchsorted(-size, -DIRECT, "left"))
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(int(size[long:].max(initial=0))):
        high = int(np.searchsorted(-size[long:], -k, "left")) + long
        here = state[long:high]
        state[long:high] = _CRC[(here ^ data[start[long:high] + k]) & 255] ^ (here >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    for i in order[:long]:
        out[i] = zlib.crc32(data[words.start[i] : words.end[i]].tobytes())
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, row, bucket) of every run of 1 to RUN words within a row."""
    words = find_words(data, offsets, ALNUM, lower=True)
    single = word_crcs(_LOWER[data], words)
    size = words.end - words.start
    crc, rows, buckets = single, [words.row], [single % BUCKETS]
    for k in range(1, RUN):
        whole = np.flatnonzero(words.row[:-k] == words.row[k:]) if len(words.row) > k else np.zeros(0, np.int64)
        spaced = ~crc[: max(len(single) - k, 0)]
        spaced = ~(_CRC[(spaced ^ np.uint32(0x20)) & 255] ^ (spaced >> np.uint32(8)))
        crc = shifted(spaced, size[k:]) ^ single[k:]
        rows.append(words.row[whole])
        buckets.append(crc[whole] % BUCKETS)
    return words, np.concatenate(rows), np.concatenate(buckets).astype(np.int64)


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(column)
    for low, high in row_slices(offsets):
        for at in range(low, high, ROWS_AT_ONCE):
            part = offsets[at : min(at + ROWS_AT_ONCE, high) + 1]
            yield at, at + len(part) - 1, data[part[0] : part[-1]], part - part[0]


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, data, offsets in _slices(batch.column(0)):
                counts += np.bincount(features(data, offsets)[2], minlength=BUCKETS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in found.collect():  # at most BUCKETS rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    total, wanted = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array(
        [math.floor(1000 * math.log((float(t) + 1) * total / ((float(s) + 1) * wanted))) for s, t in zip(source, target)], np.int64
    )


def planes(cells: np.ndarray, counts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, power, bits) of the planes with a bit set; `cells` are distinct row * BUCKETS + bucket."""
    row, bucket = np.divmod(cells, BUCKETS)
    width = _LANES * 8
    at, bit = row * width + (bucket >> 3), (1 << (bucket & 7)).astype(np.float64)
    owner, power, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((0, _LANES), np.uint64)]
    for j in range(int(counts.max(initial=0)).bit_length()):
        here = (counts >> j) & 1 == 1
        some = np.unique(row[here])
        place = np.searchsorted(some, row[here]) * width + (at[here] - row[here] * width)
        # Bits of distinct cells never meet, so their sum is their union.
        bytes_ = np.bincount(place, bit[here], minlength=len(some) * width).astype(np.uint8)
        owner.append(some)
        power.append(np.full(len(some), j))
        bits.append(bytes_.reshape(len(some), width).view(np.uint64))
    return np.concatenate(owner), np.concatenate(power), np.concatenate(bits)


def gain_planes(gain: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(sign, power, bits) of the gains' planes."""
    out = []
    for sign in (1, -1):
        size = np.maximum(sign * gain, 0)
        cells = np.flatnonzero(size)
        _, power, bits = planes(cells, size[cells], 1)
        out += [(sign, int(p), b) for p, b in zip(power, bits)]
    return out


def weights(row: np.ndarray, bucket: np.ndarray, rows: int, gain: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """Sum of the gains of each row's features."""
    cells, counts = np.unique(row * BUCKETS + bucket, return_counts=True)
    owner, power, bits = planes(cells, counts, rows)
    sums = np.zeros(len(owner), np.int64)
    for sign, k, plane in gain:
        sums += sign * (np.bitwise_count(bits & plane).sum(1, dtype=np.int64) << k)
    out = np.zeros(rows, np.int64)
    np.add.at(out, owner, sums << power)
    return out


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = gain_planes(shared.value)
        for batch in batches:
            for low, high, data, offsets in _slices(batch.column(1)):
                words, row, bucket = features(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(np.diff(words.bounds)),
                        pa.array(np.bincount(row, minlength=high - low)),
                        pa.array(weights(row, bucket, high - low, sliced)),
                    ],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Whole-numbered Gumbel noise from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, first: str, order: list[Column]) -> tuple[DataFrame, int]:
    """`rows`, written, with `rank` from 1, rows with `first` set before the others, and how many those are.

    Ranks are row numbers within sorted ranges after the rows of the ranges before.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col(first).desc(), *order, F.col("copy")]
    rows = written(rows.withColumn("copy", F.monotonically_increasing_id()))
    ranges = written(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    dropped(rows)
    held = ranges.groupBy("part").agg(F.count("*").alias("n"), F.count_if(first).alias("able")).orderBy("part").collect()  # one row a range
    starts, at = [], 0
    for part, n, _ in held:
        starts.append((part, at))
        at += n
    before = ranges.sparkSession.createDataFrame(starts, "part int, before long")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    out = ranges.withColumn("inside", inside).join(F.broadcast(before), "part")
    out = out.withColumn("rank", F.col("before") + F.col("inside").cast("long")).drop("part", "before", "inside", "copy")
    return out, sum(able for _, _, able in held)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; the rank is null where it was not drawn."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = weighted(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = scored.withColumn("able", F.col("n_words") >= least_words).drop("n_words")
    out, able = ranked(scored, "able", [F.col("score").desc(), F.col("doc_id").asc_nulls_last()])
    rank = F.when(F.col("rank") <= percent * able // 100, F.col("rank"))
    return out.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
