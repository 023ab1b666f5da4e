"""Language-model scores of documents: word counts of the training part, and a mixing model of bytes learnt from it.

Documents are training rows unless the crc32 of their id as text, modulo FOLDS, is HELD.

1. The bytes of the training texts are counted, which gives the words that stand for them (see `mixing`).
2. Every task learns its training texts online: it predicts their bits from what it has counted, refines the mixture's weights by
   the errors, and then counts the bits in the slots of the predictors. Predictions follow the counts in steps, whenever
   the bytes read have grown GROWN times. Weights of all tasks are averaged, each as it has learnt, and depend on
   how the texts lie in tasks. Blocks of slots are summed over tasks, and each slot keeps its
   log-odds in one byte: SLOTS bytes in all, whatever the input, are broadcast.
3. A third pass scores each text and lists the distinct words of a slice of texts with their training counts, in CLASSES
   of hashes. Words are counted over all slices, class by class, and each slice's documents are summed
   against the counts of its own words. A frequent word is listed once per slice, and an agreement of 64-bit hashes
   counts as the same word.

Null text is empty, and holds the end only. A null id reads as an empty one. Repeated rows count, and are scored, each.
Without training rows all counts and log-odds are 0. An empty table gives no rows. Memory follows the slice, or one
longer text, and the slices' words in one class. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import mixing
from .arrays import SPACED, find_words, row_slices, utf8
from .store import written

FOLDS, HELD = 7, 2
SLICE = 1 << 22
COUNTED = 1 << 20  # bytes whose bits are counted at once
FIRST, GROWN = 1 << 16, 4  # bytes before the first prediction; see above
CLASSES = 1 << 9  # of word hashes
SHIFT = np.uint64(64 - CLASSES.bit_length() + 1)
BLOCK = 1 << 11  # slots that travel together

ROWS = (
    "slice long, doc_id long, held_out boolean, n_bytes long, n_tokens long, score double, places binary, "
    "class int, words binary, counts binary"
)
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD


def byte_counts(texts: DataFrame) -> np.ndarray:
    """int64[256]: how often each byte, and the end of a text, occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(256, np.int64)
        for batch in batches:
            data, _ = utf8(batch.column(0))
            for low in range(0, len(data), SLICE):
                counts += np.bincount(data[low : low + SLICE], minlength=256)
            counts[mixing.END] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(counts)], ["byte", "n"])

    out = np.zeros(256, np.int64)
    for byte, n in texts.mapInArrow(run, "byte long, n long").groupBy("byte").agg(F.sum("n")).collect():
        out[byte] = n
    return out


def learnt(texts: DataFrame, code: mixing.Code) -> tuple[np.ndarray, np.ndarray]:
    """int8[PLACES, CONTEXTS << BITS] log-odds of every slot, and the weights of the mixture, after all texts."""
    wide = 2 * mixing.CONTEXTS << mixing.BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((mixing.PLACES, wide), np.int64)
        mixer, odds, seen, wait = mixing.Mixer(), None, 0, FIRST
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            low = 0
            while low < batch.num_rows:
                limit = offsets[low] + min(max(seen, FIRST), COUNTED)
                high = max(int(np.searchsorted(offsets, limit, "right")) - 1, low + 1)
                part = offsets[low : high + 1]
                mixing.learn(counts, odds, mixer, data[part[0] : part[-1]], part - part[0], code)
                low, seen = high, seen + int(part[-1] - part[0])
                if seen >= wait:
                    odds, wait = mixing.log_odds(counts.reshape(mixing.PLACES, -1, 2)), GROWN * seen
        blocks = counts.reshape(-1, 2 * BLOCK)
        most = blocks.max(1)
        some = np.flatnonzero(most)
        for low in range(0, len(some), 256):
            here = some[low : low + 256]
            held = [blocks[i].astype(np.min_scalar_type(most[i])).tobytes() for i in here]
            yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(held, pa.binary())], ["block", "counts"])
        if odds is not None:
            mixed = np.concatenate([mixer.weights.ravel(), mixer.curvature.ravel()]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([mixed], pa.binary())], ["block", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        mixers = []
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = counts.as_buffer()
                if block < 0:
                    both = np.frombuffer(raw)
                    mixers.append((both[:sets].reshape(2, -1), both[sets:].reshape(2, mixing.CONTEXTS, -1)))
                    continue
                found = np.frombuffer(raw, f"u{raw.size // (2 * BLOCK)}")
                if block in sums:
                    sums[block] += found
                else:
                    sums[block] = found.astype(np.int64)
        for block, counts in sums.items():
            odds = mixing.log_odds(counts.reshape(-1, 2)).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([odds], pa.binary())], ["block", "odds"])
        if mixers:
            yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([mixing.together(mixers).tobytes()], pa.binary())], ["block", "odds"])

    sets = 2 * mixing.CONTEXTS
    weights = mixing.together([])
    found = texts.mapInArrow(run, "block long, counts binary").repartition("block").mapInArrow(total, "block long, odds binary")
    out = np.zeros((mixing.SLOTS // BLOCK, BLOCK), np.int8)
    for block, odds in found.collect():  # SLOTS bytes at most, and the weights
        if block < 0:
            weights = np.frombuffer(odds).reshape(2, -1)
        else:
            out[block] = np.frombuffer(odds, np.int8)
    return out.reshape(mixing.PLACES, -1), weights


def _packed(place: np.ndarray, bounds: np.ndarray, distinct: int) -> list[bytes]:
    """Places of each document's words, in as few bytes as hold those of a slice."""
    if not 1 << 16 < distinct <= 1 << 24:
        place = place.astype(np.min_scalar_type(max(distinct - 1, 0)))
        return [place[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
    low, high = place.astype(np.uint16), (place >> 16).astype(np.uint8)
    return [low[a:b].tobytes() + high[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def _unpacked(raw: pa.Buffer, n: int) -> np.ndarray:
    if raw.size != 3 * n:
        return np.frombuffer(raw, f"u{raw.size // n}") if n else np.zeros(0, np.uint8)
    return np.frombuffer(raw, np.uint16, n) + (np.frombuffer(raw, np.uint8, n, 2 * n).astype(np.int64) << 16)


def _narrow(counts: np.ndarray) -> bytes:
    return counts.astype(np.min_scalar_type(counts.max(initial=0))).tobytes()


def _widened(raw: pa.Buffer, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{raw.size // n}").astype(np.int64)


def _scored(docs: DataFrame, odds: np.ndarray, weights: np.ndarray, code: mixing.Code) -> DataFrame:
    """ROWS: each document with the places of its words in its slice's list, and the list in classes that hold any."""
    shared = docs.sparkSession.sparkContext.broadcast((odds, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("slice", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_bytes", pa.int64()),
                ("n_tokens", pa.int64()), ("score", pa.float64()), ("places", pa.binary()),
                ("class", pa.int32()), ("words", pa.binary()), ("counts", pa.binary()),
            ]
        )
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for low, high in row_slices(offsets, SLICE):
                part = offsets[low : high + 1]
                piece, part = data[part[0] : part[-1]], part - part[0]
                bits = mixing.bits_of(piece, part, shared.value[0], code, shared.value[1])
                words = find_words(piece, part, SPACED, lower=True)
                distinct, place = np.unique(words.hash, return_inverse=True)
                held = batch.column(2).slice(low, high - low)
                training = ~held.to_numpy(zero_copy_only=False).astype(bool)
                counts = np.bincount(place[training[words.row]], minlength=len(distinct))
                n = high - low
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, number)),
                        batch.column(0).slice(low, n),
                        held,
                        pa.array(np.diff(part)),
                        pa.array(np.diff(words.bounds) + 1),
                        pa.array(-bits * np.log10(2.0)),
                        pa.array(_packed(place, words.bounds, len(distinct)), pa.binary()),
                        *(pa.nulls(n, f.type) for f in list(schema)[7:]),
                    ],
                    schema=schema,
                )
                # Hashes are sorted, so a class is a range of them.
                kind, first = np.unique(distinct >> SHIFT, return_index=True)
                ends = [*first[1:].tolist(), len(distinct)]
                lists = [
                    pa.array(kind.astype(np.int32)),
                    pa.array([distinct[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                    pa.array([_narrow(counts[a:b]) for a, b in zip(first, ends)], pa.binary()),
                ]
                n = len(kind)
                row = [pa.array(np.full(n, number)), *(pa.nulls(n, f.type) for f in list(schema)[1:7]), *lists]
                yield pa.RecordBatch.from_arrays(row, schema=schema)
                number += 1

    return written(docs.mapInArrow(run, ROWS))


def _totals(rows: pa.Table) -> pa.Table:
    """One class of all slices: the training counts of the slices' words, and, once, how many words have any."""
    words = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("words")]
    counts = [_widened(x.as_buffer(), len(w)) for x, w in zip(rows.column("counts"), words)]
    distinct, place = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)
    ends = np.cumsum([len(w) for w in words])[:-1]
    found = [_narrow(total[x]) for x in np.split(place, ends)]
    known = np.zeros(rows.num_rows, np.int64)
    known[0] = np.count_nonzero(total)
    sizes = pa.array([len(w) for w in words], pa.int64())
    return pa.table({"slice": rows.column("slice"), "class": rows.column("class"), "found": pa.array(found, pa.binary()), "n": sizes, "distinct": known})


def _summed(rows: DataFrame, tokens: int, distinct: int, ends: int) -> DataFrame:
    """SCORES of the documents of whole slices; a slice's counts stand before its documents, in the order of classes."""
    size = float(tokens + distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, logs, lists, number = np.zeros(0, np.int64), np.zeros(0), [], None
        end = float(np.log10((ends + 1) / size))
        for batch in batches:
            n_tokens, n_listed, listed = batch.column(4).to_pylist(), batch.column(9).to_pylist(), batch.column(8).is_valid().to_pylist()
            base, known = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            numbers = batch.column(0).to_pylist()
            for i, (held, found) in enumerate(zip(batch.column(6), batch.column(8))):
                if numbers[i] != number:
                    number, counts, lists = numbers[i], np.zeros(0, np.int64), []
                if listed[i]:
                    lists.append(_widened(found.as_buffer(), n_listed[i]))
                    continue
                if lists:
                    counts, lists = np.concatenate(lists), []
                    logs = np.log10((counts + 1) / size)
                place = _unpacked(held.as_buffer(), n_tokens[i] - 1)
                base[i] = logs[place].sum() + end
                known[i] = np.count_nonzero(counts[place]) + (ends > 0)
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column(1), batch.column(2), batch.column(4), pa.array(known),
                    pa.array(np.full(batch.num_rows, tokens)), pa.array(base), batch.column(5), batch.column(3),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"],
            )
            yield out.filter(batch.column(8).is_null())

    return rows.repartition("slice").sortWithinPartitions("slice", F.col("found").isNull(), "class").mapInArrow(run, SCORES)


def score_documents(docs: DataFrame) -> DataFrame:
    """SCORES of every document, with the bits its text takes per byte, its end included."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    training = docs.where("NOT held_out").select("text")
    code = mixing.code_of(byte_counts(training))
    odds, weights = learnt(training, code)
    rows = _scored(docs, odds, weights, code)
    words = rows.where("words IS NOT NULL").select("slice", "class", "words", "counts")
    lists = written(words.groupBy("class").applyInArrow(_totals, "slice long, class int, found binary, n long, distinct long"))
    distinct = lists.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    sizes = rows.where("words IS NULL AND NOT held_out").agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count("*"))
    tokens, ends = sizes.first()

    kept = ["slice", "doc_id", "held_out", "n_bytes", "n_tokens", "score", "places"]
    whole = rows.where("words IS NULL").select(*kept, F.lit(None).cast("int").alias("class"), F.lit(None).cast("binary").alias("found"), F.lit(None).cast("long").alias("n"))
    lists = lists.select("slice", *(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in kept[1:]), "class", "found", "n")
    out = _summed(whole.unionByName(lists), tokens, distinct + (ends > 0), ends)
    bits = -F.col("score") / F.log10(F.lit(2.0)) / (F.col("n_bytes") + 1)
    return out.withColumn("bits_per_byte", bits).drop("n_bytes")
