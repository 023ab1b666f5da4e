"""Harmonic packing of tokenised documents into sequences of CAPACITY tokens.

Class j holds pieces of CAPACITY // (j + 1) + 1 to CAPACITY // j tokens; any j of them fill one bin. Documents are cut
so that pieces come close to the upper end of their class: full sequences first, then from the rest r
either r itself, where j pieces like it leave at most SLACK tokens of a bin or r is under SHORT, or the
largest class size below r and on with what remains. Pieces are numbered within their class; every j
in a row make a sequence, so the classes are filled independently of each other and of the number of workers.
Fewer than j pieces are left over per class, at most about CAPACITY * ln(CAPACITY) of them in all whatever the input; these
are put into sequences by first fit, longest first, in one task.

Numbers within a class come from counts per class and bucket of doc_id, then within each bucket.
Null or empty text is one piece holding the separator. Repeated rows are packed each; rows sharing a
doc_id keep separate pieces. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import dropped, written

CAPACITY = 1024
SLACK = 20
SHORT = 48
SEPARATOR = 0

PIECES = "doc_id long, row long, start long, length int, ids_crc32 long, doc_tokens long, class int"

#: How byte-level BPE files split text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def cuts(n: int) -> list[int]:
    """Lengths of the pieces of a document of n tokens."""
    out = [CAPACITY] * (n // CAPACITY)
    n %= CAPACITY
    while n:
        j = CAPACITY // n
        take = n if n < SHORT or CAPACITY - j * n <= SLACK else CAPACITY // (j + 1)
        out.append(take)
        n -= take
    return out


class FastTokenizer:
    """The ids of a byte-level BPE file of the tokenizers library, by tiktoken's faster merging of the same vocabulary.

    In such a vocabulary ids are merge ranks. Texts that hold a special token's string are left to tokenizers.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.special = [t["content"] for t in given["added_tokens"]]
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        spelled = {chr(b): b for b in plain}
        spelled |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(map(spelled.__getitem__, t)): i for t, i in given["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


_tokenizers: dict[str, FastTokenizer] = {}


def pieces(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizers.get(tokenizer_path) or _tokenizers.setdefault(tokenizer_path, FastTokenizer(tokenizer_path))
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows, out = [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    ids = np.append(tokenizer.encode(text or ""), np.uint32(SEPARATOR)).astype("<u4")
                    at = 0
                    for n in cuts(len(ids)):
                        rows.append(i)
                        out.append((at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids), CAPACITY // n))
                        at += n
                columns = [np.array(c, np.int64) for c in zip(*out)]
                columns[1], columns[4] = columns[1].astype(np.int32), columns[4].astype(np.int32)
                take = pa.array(np.array(rows, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), *map(pa.array, columns)],
                    ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens", "class"],
                )

    numbered = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), "text")
    return numbered.mapInArrow(run, PIECES)


def first_fit(left: pd.DataFrame) -> pd.DataFrame:
    """Sequences (from 0) and offsets of the pieces that no class could fill a bin with."""
    left = left.sort_values(["length", "doc_id", "row", "start"], ascending=[False, True, True, True], kind="stable")
    room: list[int] = []
    where, offset = [], []
    for n in left["length"]:
        k = next((k for k, free in enumerate(room) if free >= n), len(room))
        if k == len(room):
            room.append(CAPACITY)
        where.append(k)
        offset.append(CAPACITY - room[k])
        room[k] -= n
    return left.assign(sequence_id=where, offset=offset)


def pack(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = written(pieces(docs, tokenizer_path))
    # Pieces of a class and bucket: the bucket is a row range of bounded length, not a key of the data.
    bucket = F.shiftright("row", 12)
    counts = cut.groupBy("class", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    by_class = counts.groupBy("class").agg(F.sum("n").alias("total"))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    sums = by_class.withColumn("bins", F.floor(F.col("total") / F.col("class")))
    # At most CAPACITY classes, so at most CAPACITY rows in this window.
    prior = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("first_bin", F.coalesce(F.sum("bins").over(prior), F.lit(0)))
    sums = written(sums.select("class", "total", "bins", "first_bin"))
    all_bins = sums.agg(F.coalesce(F.sum("bins"), F.lit(0))).first()[0]

    inside = Window.partitionBy("class", "bucket").orderBy("row", "start")
    numbered = cut.withColumn("bucket", bucket).withColumn("nth", F.row_number().over(inside) - 1)
    numbered = numbered.join(counts, ["class", "bucket"]).join(F.broadcast(sums), "class")  # at most CAPACITY rows
    numbered = numbered.withColumn("nth", F.col("nth") + F.col("before"))
    numbered = numbered.withColumn("bin", F.floor(F.col("nth") / F.col("class")))
    numbered = written(numbered.drop("bucket", "before"))
    dropped(cut)
    full = numbered.where("bin < bins").withColumn("sequence_id", F.col("first_bin") + F.col("bin"))
    order = Window.partitionBy("sequence_id").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def rest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = pd.concat(list(frames) or [pd.DataFrame(columns=["length"])])
        if len(left):
            left = first_fit(left)
            left["sequence_id"] += all_bins
            yield left[names]

    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    left = numbered.where("bin >= bins").select("doc_id", "row", "start", "length", "ids_crc32", "doc_tokens")
    left = left.repartition(1).mapInPandas(rest, kinds)
    full = full.select(*(F.col(n).cast("long") for n in names))
    return full.unionByName(left)
