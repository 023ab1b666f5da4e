"""Exact Jaccard join of documents on 5-word shingles, and its connected components.

1. A first pass over all documents counts shingles in a fixed number of buckets, which orders
   shingles from rare to frequent. The order is only a heuristic, but the same for all documents.
2. A second pass gives each document its set size, a fingerprint of its set, its count vector and,
   in that order, its first n - ceil(0.8 n) + 1 shingles. Two sets that link share one of these, so the
   postings of a shingle form a block, and each block has its own R-tree of count vectors. Documents
   with equal sets are one point. Blocks with the same members are searched once.
3. In a turn, each point takes its best partner of another component over the trees of its blocks; the
   exact sets decide, and links join components. After TURNS turns, or one without a link, blocks
   that still hold several components are searched for every pair across them. Links inside a
   component cannot change it, so nothing is lost, and near copies are not turned into all their pairs.
Blocks of more than TILE points are dealt to tiles, anew each turn, and at the end to all pairs of tiles.

Null or wordless text has an empty set and links with nothing. Rows with the same doc_id are
treated as copies of that id. Other columns are not read; an empty table gives no rows. Very long texts are read
whole; a task holds the shingles of a slice of rows at a time, and the texts of a batch of pairs where they are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import SPACED, U64, find_words, mix, row_slices, utf8, windows
from .components import components
from .rtree import FAN_OUT, CountTree, needed
from .store import dropped, written

K = 5
BUCKETS = 1 << 20
GROUPS = 512
TILE = 2048
TURNS = 2

INDEX = "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>, counts binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, sorted by row and hash."""
    words = find_words(data, offsets, SPACED, lower=True)
    at, h = windows(words, K)
    rows, hashes = [words.row[at]], [h]
    n = np.diff(words.bounds)
    for k in range(1, K):
        if (n == k).any():
            at, h = windows(words, k)
            short = n[words.row[at]] == k
            rows.append(words.row[at][short])
            hashes.append(h[short])
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (np.diff(row) != 0) | (h[1:] != h[:-1])
    return row[fresh], h[fresh]


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> U64(44)).astype(np.int64)


def slices_of(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(batch.column(column))
    for low, high in row_slices(offsets):
        part = offsets[low : high + 1]
        yield low, high, data[part[0] : part[-1]], part - part[0]


def frequent_buckets(docs: DataFrame) -> np.ndarray:
    """For each bucket 0, or the binary logarithm of its count where some task found it well above the mean.

    Fixed size (BUCKETS bytes), whatever the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, data, offsets in slices_of(batch, 0):
                counts += np.bincount(bucket(shingle_sets(data, offsets)[1]), minlength=BUCKETS)
        high = np.flatnonzero(counts > 8 + 3 * counts.mean())
        yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(counts[high])], ["bucket", "n"])

    found = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = found.toPandas()  # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.uint8)
    out[found["bucket"].to_numpy(np.int64)] = np.log2(found["n"].to_numpy(np.float64) + 1).astype(np.uint8)
    return out


def index(docs: DataFrame) -> DataFrame:
    classes = docs.sparkSession.sparkContext.broadcast(frequent_buckets(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices_of(batch, 1):
                row, h = shingle_sets(data, offsets)
                n = np.bincount(row, minlength=high - low)
                bounds = np.r_[0, np.cumsum(n)]
                sums = [np.r_[U64(0), np.cumsum(mix(h ^ U64(salt)))] for salt in (0, 0x5DEECE66D)]
                sums = [(s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums]
                order = np.lexsort((h, classes.value[bucket(h)], row))
                first = np.repeat(n - (4 * n + 4) // 5 + (n > 0), n)
                keys = h[order][np.arange(len(h)) - bounds[row] < first].view(np.int64)
                taken = np.r_[0, np.cumsum(n - (4 * n + 4) // 5 + (n > 0))]
                cell = row * GROUPS + (mix(h ^ U64(77)) % U64(GROUPS)).astype(np.int64)
                counts = np.bincount(cell, minlength=(high - low) * GROUPS).reshape(-1, GROUPS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(n),
                        *map(pa.array, sums),
                        pa.ListArray.from_arrays(pa.array(taken.astype(np.int32)), pa.array(keys)),
                        pa.array([c.astype(np.min_scalar_type(m)).tobytes() for c, m in zip(counts, counts.max(1))], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "keys", "counts"],
                )

    return written(docs.select("doc_id", "text").mapInArrow(run, INDEX))


def _whole_groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of whole groups with the groups' first rows and the end, out of batches sorted by `by`."""
    held = None
    for batch in batches:
        batch = pd.concat([held, batch], ignore_index=True) if held is not None else batch
        if not len(batch):
            continue
        keys = batch[by].to_numpy()
        edges = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        if edges[-1]:
            yield batch.iloc[: edges[-1]], edges
        held = batch.iloc[edges[-1] :]
    if held is not None:
        yield held, np.array([0, len(held)])


def candidates(frame: pd.DataFrame, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, bound): rows of one group, in different components, whose overlap bound reaches what they need.

    A group that fits one leaf is a tree of one node: all such groups of the frame are searched together.
    """
    counts = np.array([np.frombuffer(c, f"u{len(c) // GROUPS}") for c in frame["counts"]])
    sizes, part, tile = (frame[c].to_numpy() for c in ("n_shingles", "component", "tile"))
    length = np.diff(edges)
    small = length <= FAN_OUT
    end = np.repeat(np.where(small, edges[1:], 0), length)
    for step in range(1, int(length[small].max(initial=1))):
        i = np.flatnonzero(np.arange(len(frame)) + step < end)
        j = i + step
        apart = part[i] != part[j]
        i, j = i[apart], j[apart]
        bound = np.minimum(counts[i], counts[j]).sum(1, dtype=np.int64)
        ok = bound >= needed(sizes[i], sizes[j])
        yield i[ok], j[ok], bound[ok]
    for low, high in zip(edges[:-1][~small], edges[1:][~small]):
        if (part[low:high] == part[low]).all():
            continue
        tree = CountTree(counts[low:high], sizes[low:high])
        two = tile[low:high].min() != tile[low:high].max()
        for i, j, bound in tree.search(counts[low:high], sizes[low:high]):
            i, j = i + low, j + low
            ok = (i < j) & (part[i] != part[j]) & ((tile[i] != tile[j]) | (not two))
            yield i[ok], j[ok], bound[ok]


def best_partners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each point of a group its best partner in another component, by how far the bound exceeds the need: at most one row a point."""
    for frame, edges in _whole_groups(batches, ["key", "left", "right"]):
        ids, sizes = frame["doc_id"].to_numpy(), frame["n_shingles"].to_numpy()
        best, partner = np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        for i, j, bound in candidates(frame, edges):
            score = bound / needed(sizes[i], sizes[j])
            i, j, score = np.r_[i, j], np.r_[j, i], np.r_[score, score]
            order = np.lexsort((ids[j], -score, i))
            first = order[np.r_[True, np.diff(i[order]) != 0]] if len(order) else order
            i, other, score = i[first], ids[j[first]], score[first]
            better = (score > best[i]) | ((score == best[i]) & (other < partner[i]))
            best[i[better]], partner[i[better]] = score[better], other[better]
        found = np.flatnonzero(best)
        if len(found):
            yield pd.DataFrame({"doc_id": ids[found], "partner": partner[found], "score": best[found]})


def all_partners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame, edges in _whole_groups(batches, ["key", "left", "right"]):
        ids = frame["doc_id"].to_numpy()
        for i, j, _ in candidates(frame, edges):
            a, b = ids[i], ids[j]
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs whose sets reach the similarity, decided on the texts themselves, of which only those of pairs are moved."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            order = pa.array(np.arange(2 * n).reshape(2, n).T.ravel())
            both = pa.chunked_array([batch.column(2), batch.column(3)]).combine_chunks().take(order)
            data, offsets = utf8(both)
            ok = []
            for low, high in row_slices(offsets[::2]):
                part = offsets[2 * low : 2 * high + 1]
                row, h = shingle_sets(data[part[0] : part[-1]], part - part[0])
                size = np.bincount(row, minlength=2 * (high - low)).reshape(-1, 2)
                by = np.lexsort((h, row // 2))
                twice = (np.diff(row[by] // 2) == 0) & (h[by][1:] == h[by][:-1])
                common = np.bincount(row[by][1:][twice] // 2, minlength=high - low)
                union = size.sum(1) - common
                ok.append((100 * common >= 80 * union) & (union > 0))
            keep = pa.array(np.concatenate(ok) if ok else np.zeros(0, bool))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _dealt(members: DataFrame, vectors: DataFrame, parts: DataFrame | None, turn: int | None) -> DataFrame:
    """Points of blocks with several components, whole tiles together and sorted: the tiles of a turn, or all pairs of tiles."""
    if parts is None:
        members = members.withColumn("component", F.col("doc_id"))
    else:
        members = members.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        members = members.withColumn("component", F.coalesce("component", "doc_id"))
        mixed = members.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d"))
        members = members.join(mixed.where("c < d").select("key"), "key", "left_semi")
    tile = F.pmod(F.hash("doc_id", F.lit(turn or 0)), "tiles").cast("int")
    members = members.withColumn("tile", tile)
    if turn is None:
        every = F.transform(
            F.sequence(F.lit(0), F.col("tiles") - 1),
            lambda t: F.struct(F.least(t, "tile").alias("left"), F.greatest(t, "tile").alias("right")),
        )
        members = members.select("key", "tile", "doc_id", "component", F.inline(every))
    else:
        members = members.withColumns({"left": F.col("tile"), "right": F.col("tile")})
    fan = max(2, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = members.join(vectors, "doc_id")
    rows = rows.select("key", "left", "right", "tile", "doc_id", "component", "n_shingles", "counts")
    return rows.repartition(fan, "key", "left", "right").sortWithinPartitions("key", "left", "right")


def _one_each(rows: DataFrame) -> DataFrame:
    best = rows.mapInPandas(best_partners, "doc_id long, partner long, score double").groupBy("doc_id")
    best = best.agg(F.max_by("partner", F.struct("score", "partner")).alias("partner"))
    return best.select(F.least("doc_id", "partner").alias("a"), F.greatest("doc_id", "partner").alias("b")).distinct()


def near_duplicates(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    table = index(docs)
    sets = ["n_shingles", "set_a", "set_b"]
    classes = table.where("n_shingles > 0").groupBy(*sets).agg(F.min("doc_id").alias("rep"))
    classes = written(classes)
    points = table.select("doc_id", "keys").join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    # Most postings stand alone, so they are read from the index twice rather than stored.
    postings = points.select(F.explode("keys").alias("key"), "doc_id")
    shared = written(postings.groupBy("key").count().where("count > 1").select("key"))
    together = written(postings.join(shared, "key"))
    dropped(shared)
    hashed = F.xxhash64("doc_id")
    blocks = together.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(hashed).alias("x"), F.sum(hashed.bitwiseAND(0x7FFFFFFF)).alias("y")
    )
    blocks = blocks.groupBy("n", "x", "y").agg(F.min("key").alias("key"))
    blocks = blocks.select("key", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    members = written(together.join(blocks, "key"))
    dropped(together)
    involved = members.select("doc_id").distinct()
    vectors = written(table.select("doc_id", "n_shingles", "counts").join(involved, "doc_id", "left_semi"))

    # Texts are read from the input at each verification, not copied. Pairs are written before they are verified, so that the shuffles of vectors and of texts are never held together.
    pairs = written(_one_each(_dealt(members, vectors, None, 0)))
    links = written(verified(pairs, docs))
    dropped(pairs)
    for turn in range(1, TURNS):
        parts = written(components(links, "a", "b"))
        pairs = written(_one_each(_dealt(members, vectors, parts, turn)))
        found = written(verified(pairs, docs))
        last, links = links, written(links.unionByName(found))
        done = found.isEmpty()
        dropped(last, parts, pairs, found)
        if done:
            break
    parts = written(components(links, "a", "b"))
    rest = written(_dealt(members, vectors, parts, None).mapInPandas(all_partners, "a long, b long").distinct())
    dropped(members, vectors, parts)
    more = written(links.unionByName(verified(rest, docs)))
    dropped(links, rest)

    parts = components(more, "a", "b")
    dropped(more)
    classes = classes.join(parts, F.col("rep") == F.col("id"), "left")
    classes = classes.select(*sets, F.coalesce("component", "rep").alias("component"))
    out = table.select("doc_id", *sets).join(classes, sets, "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
