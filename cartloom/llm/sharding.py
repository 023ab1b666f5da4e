"""Shards of nearly equal bytes by sampled splitters, in built-in functions only.

Documents are keyed by a hash of their text, so equal texts are neighbours. Splitters are quantiles of a size-weighted
sample of keys; they cut the keys into RANGES ranges. A key whose texts exceed a small share of a shard is an overfull
range of its own, subdivided by a hash of doc_id and row number, so that repeated rows part too. Bytes are added up within ranges and over the few
ranges, and a unit (a key, or a part of an overfull one) goes where the middle of its bytes falls among the shards.

Null text counts no bytes but its one; repeated rows are placed each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import dropped, written

RANGES = 256
SAMPLES = 16_384
#: Ranges of more bytes are subdivided, so that numbering the rows of one stays a task's work.
RANGE_BYTES = 1 << 30
#: A unit's largest share of a shard, unless one text alone is larger.
SHARE = 0.002


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; the law is `bytes`."""
    text = F.coalesce("text", F.lit(""))
    rows = written(
        docs.select(
            "doc_id",
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.monotonically_increasing_id().alias("copy"),
        )
    )
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    most = max(1, int(total / shards * SHARE))
    keys = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    # At most total / most keys, that is shards / SHARE, are overfull.
    overfull = keys.where(F.col("bytes") > most).select("key", F.ceil(F.col("bytes") / most).alias("parts"))
    rows = rows.join(F.broadcast(overfull), "key", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("doc_id", "copy"), "parts"), F.lit(-1))
    )
    units = rows.groupBy("key", "part").agg(F.sum("size").alias("bytes"))

    uniform = F.pmod(F.xxhash64("key", "part", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    sample = units.where(uniform < F.col("bytes") * (SAMPLES / max(1, total)))
    cuts = sample.agg(F.percentile_approx("key", [k / RANGES for k in range(1, RANGES)], 10 * RANGES)).first()[0] or []
    edges = F.array(*map(F.lit, [-(1 << 63), *sorted(set(cuts)), (1 << 63) - 1]))
    place = F.size(F.filter(edges, lambda c: c <= F.col("key")))
    # Keys are hashes, so equal steps of the key subdivide a range evenly.
    steps = max(1, -(-total // (RANGES * RANGE_BYTES)))
    low, high = F.element_at(edges, place).cast("double"), F.element_at(edges, F.least(place + 1, F.size(edges))).cast("double")
    step = F.floor((F.col("key").cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * steps)
    place = place * F.lit(steps) + F.least(F.lit(steps - 1), step)
    own = F.when(F.col("part") >= 0, F.col("key")).otherwise(0)
    units = units.select("key", "part", "bytes", place.alias("range"), own.alias("own"))

    # One row per RANGE_BYTES, or part of an overfull key, so one task may order them.
    inside = ["range", "own", "part"]
    sums = units.groupBy(*inside).agg(F.sum("bytes").alias("n"))
    line = Window.orderBy(*inside)
    before = F.coalesce(F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*inside, before.alias("start"))
    units = units.join(F.broadcast(sums), inside)
    running = Window.partitionBy("range", "own", "part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("start") + F.coalesce(F.sum("bytes").over(running), F.lit(0)) + F.col("bytes") / 2
    target = F.least(F.lit(shards - 1), F.floor(middle * shards / max(1, total))).cast("int")
    units = written(units.select("key", "part", "range", "own", target.alias("shard")))

    placed = written(rows.drop("parts").join(units, ["key", "part"]))
    inside = ["shard", "range", "own", "part"]
    counts = placed.groupBy(*inside).agg(F.count("*").alias("n"))
    line = Window.partitionBy("shard").orderBy("range", "own", "part")
    before = F.coalesce(F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*inside, before.alias("start"))
    placed = placed.join(F.broadcast(counts), inside)
    nth = F.row_number().over(Window.partitionBy(*inside).orderBy("key", "doc_id", "copy")) - 1
    out = placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + nth).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
    dropped(units)
    return out
