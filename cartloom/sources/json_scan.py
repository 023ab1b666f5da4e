"""Scanning landed JSON files: the layout is found per file, and large arrays are cut into elements over many tasks.

Files are read once, as fragments that end at a closing brace, which splits any file at block bounds. They are kept with their
net depth and quotes, for a start outside and inside a text, in the shared scratch folder. One pass sums up each block, so that the
state at the start of every block follows from the blocks before it. A second pass counts depth from there and cuts pieces
where it comes back to one; these are kept too, and the elements that cross a block's end are put together from them.
Both passes number fragments within a block only, and a block ends after ``BLOCK`` fragments, so that what a task
holds at once does not follow the size of a split.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..operators.bronze import RECORD
from ..session import kept

_END = "end of the text, read by cartloom"
# Fragments of a block at most. Windows hold a whole block, several times over and many times as large as its text.
BLOCK = 1 << 16
_BLOCK = ("_file", "_split", "_part")
ARRAY, OBJECT, LINES, BROKEN = "array", "object", "lines", "broken"


def _closed(text: Column) -> Column:
    # The parser stops after the first value; a last element of our own shows that it read the text to its end.
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))


def _opened(closed: Column) -> Column:
    read = F.try_variant_get(closed, "$[1]", "string") == _END
    return F.when(read, F.try_variant_get(closed, "$[0]", "variant"))


def parsed_whole(text: Column) -> Column:
    """The one JSON value of ``text``; NULL when it cannot be parsed or goes on after its first value."""
    return _opened(_closed(text))


def elements_of(document: Column) -> Column:
    """The elements of an array, or the value itself; one NULL for no value."""
    return F.coalesce(F.try_variant_get(document, "$", "array<variant>"), F.array(document))


def line_records(raw: DataFrame) -> DataFrame:
    """Records of text rows ``(_file, value)``, one JSON value a row."""
    rows = raw.filter(F.col("value").rlike(r"\S"))
    rows = rows.select("_file", parsed_whole(F.col("value")).alias("_document"), F.xxhash64("value").alias("_line"))
    rows = rows.select("_file", "_line", F.posexplode(elements_of(F.col("_document"))).alias("_position", RECORD))
    return rows.select("_file", F.xxhash64("_line", "_position").alias("_row_tag"), RECORD)


def listed_files(reader, paths: str | Sequence[str]) -> DataFrame:
    """``_file`` of every file below ``paths``; contents are not read. ``reader`` is ``spark.read`` or ``spark.readStream``."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return reader.format("binaryFile").schema(schema).load(paths).select(F.col("_metadata.file_path").alias("_file"))


def _loadable(files: Sequence[str]) -> list[str]:
    """Paths for a reader, which takes them undecoded and as patterns."""
    return [re.sub(r"([{}\[\]*?\\])", r"\\\1", unquote(f)) for f in sorted(files)]


def _fragments(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    raw = spark.read.format("text").option("lineSep", "}").load(_loadable(paths))
    rows = raw.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_nth"),
        "value",
    )
    # Fragments of a split are numbered in the low 33 bits.
    rows = rows.withColumn("_part", F.floor(F.col("_nth").bitwiseAND((1 << 33) - 1) / F.lit(BLOCK)))
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    texts = r'"[^"]*(?:"|$)'
    rows = rows.withColumns(
        {
            "quotes": F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit(""))),
            "plain": F.regexp_replace(bare, texts, ""),
            "resumed": F.regexp_replace(F.concat(F.lit('"'), bare), texts, ""),
        }
    )
    net = lambda c: F.regexp_count(c, F.lit(r"[{\[]")) - F.regexp_count(c, F.lit(r"[}\]]"))
    odd = F.col("quotes") % 2
    # Every fragment ends with a brace, which counts where it stands outside texts; the last of a file is seen to later.
    rows = rows.withColumns({"outside": net("plain") - (1 - odd), "inside": net("resumed") - odd})
    tail = F.col("plain")
    for _ in range(3):
        tail = F.regexp_replace(tail, r"(?<=\S)\s*\[[^\[\]{}]*\]", "0")
    closes = F.col("plain").rlike(r"\]\s*$") & tail.rlike(r"^\s*\[?[^\[\]{}]*\]\s*$")
    torn = lambda c: F.col(c).rlike(r"\]\s*[\[{]")  # no comma between two values
    return rows.select(
        "_file", "_split", "_part", "_nth", "value", "quotes", "outside", "inside", closes.alias("closes"),
        torn("plain").alias("torn_plain"), torn("resumed").alias("torn_resumed"),
        F.regexp_extract("value", r"^\s*(\S)", 1).alias("first"),
    )


def _in_block() -> WindowSpec:
    return Window.partitionBy(*_BLOCK).orderBy("_nth")


def _before(c: str, window: WindowSpec | None = None) -> Column:
    """Sum of what stands before a row, in its block or another window."""
    window = (window or _in_block()).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(c).over(window), F.lit(0))


def _followed(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Fragments of the blocks in ``states``: ``odd`` where one starts inside a text, and the depth ``after`` it."""
    states = states.select(*_BLOCK, "_block", F.col("inside").alias("in_text"), "depth")
    rows = rows.join(states, [*_BLOCK])
    rows = rows.withColumn("odd", (F.col("in_text") + _before("quotes")) % 2)
    rows = rows.withColumn("net", F.when(F.col("odd") == 0, F.col("outside")).otherwise(F.col("inside")))
    return rows.withColumn("after", F.col("depth") + F.sum("net").over(_in_block()))


def _blocks(rows: DataFrame) -> DataFrame:
    """One row a block of fragments: its names, ``_block, inside, depth, layout``; its first byte, the state there and the layout of its file."""
    all_rows = rows.select(*_BLOCK, "_nth", "quotes", "outside", "inside")
    rows = rows.withColumn("bytes", F.octet_length("value") + 1).drop("value").withColumn("odd", _before("quotes") % 2)
    from_out = F.when(F.col("odd") == 0, F.col("outside")).otherwise(F.col("inside"))
    from_in = F.when(F.col("odd") == 0, F.col("inside")).otherwise(F.col("outside"))
    torn_out = F.when(F.col("odd") == 0, F.col("torn_plain")).otherwise(F.col("torn_resumed"))
    torn_in = F.when(F.col("odd") == 0, F.col("torn_resumed")).otherwise(F.col("torn_plain"))
    rows = rows.withColumns({"from_out": from_out, "from_in": from_in, "torn_out": torn_out, "torn_in": torn_in})
    blocks = rows.groupBy(*_BLOCK).agg(
        F.sum("bytes").alias("bytes"),
        F.sum("quotes").alias("quotes"),
        F.sum("from_out").alias("from_out"),
        F.sum("from_in").alias("from_in"),
        F.max_by("closes", "_nth").alias("closes"),
        F.max("torn_out").alias("torn_out"),
        F.max("torn_in").alias("torn_in"),
        F.min_by("first", F.when(F.col("first") != "", F.col("_nth"))).alias("first"),
    )
    in_file = Window.partitionBy("_file").orderBy("_split", "_part")
    blocks = blocks.withColumn("_block", _before("bytes", in_file))
    blocks = blocks.withColumn("inside", (_before("quotes", in_file) % 2).cast("int"))
    blocks = blocks.withColumn("net", F.when(F.col("inside") == 0, F.col("from_out")).otherwise(F.col("from_in")))
    blocks = blocks.withColumn("depth", _before("net", in_file))
    files = blocks.groupBy("_file").agg(
        F.sum("net").alias("total"),
        (F.min("_split") == F.max("_split")).alias("one"),
        F.max_by("closes", "_block").alias("closes"),
        F.max(F.when(F.col("inside") == 0, F.col("torn_out")).otherwise(F.col("torn_in"))).alias("torn"),
        F.min_by("first", F.when(F.col("first") != "", F.col("_block"))).alias("first"),
    )
    # The brace assumed after the last fragment takes the depth of a whole array to -1.
    whole = F.when((F.col("total") == -1) & F.col("closes") & ~F.col("torn"), ARRAY).otherwise(BROKEN)
    layout = F.when(F.col("first") == "[", whole).when(F.col("one") & (F.col("total") <= 0), OBJECT).otherwise(LINES)
    blocks = kept(blocks.join(files.select("_file", layout.alias("layout")), "_file").select(*_BLOCK, "_block", "inside", "depth", "layout"))
    # One object comes back to depth zero once, which is counted where a file could be one.
    followed = _followed(all_rows, blocks.where(F.col("layout") == OBJECT))
    top = (F.col("after") == 0) & ((F.col("odd") + F.col("quotes")) % 2 == 0)
    tops = followed.groupBy("_file").agg(F.count_if(top).alias("tops"))
    layout = F.when((F.col("layout") == OBJECT) & (F.col("tops") != 1), LINES).otherwise(F.col("layout"))
    return blocks.join(tops, "_file", "left").withColumn("layout", layout).drop("tops")


def _array_records(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Records of whole arrays, from the fragments and blocks of all files."""
    rows = rows.select(*_BLOCK, "_nth", "value", "quotes", "outside", "inside")
    rows = _followed(rows, blocks.where(F.col("layout") == ARRAY))
    ends = ((F.col("odd") + F.col("quotes")) % 2 == 0) & (F.col("after") == 1)
    rows = rows.withColumn("ends", ends.cast("int")).withColumn("piece", _before("ends"))
    goes_on = (F.col("_block") > 0) & (F.col("piece") == 0) & ~((F.col("in_text") == 0) & (F.col("depth") == 1))
    text = F.concat_ws("}", F.transform(F.array_sort(F.collect_list(F.struct("_nth", "value"))), lambda x: x["value"]))
    pieces = rows.groupBy(*_BLOCK, "_block", "piece").agg(
        text.alias("text"), (F.max("ends") == 1).alias("closed"), F.max(goes_on.cast("int")).alias("goes_on")
    )
    pieces = kept(pieces.withColumn("text", F.when(F.col("closed"), F.concat("text", F.lit("}"))).otherwise(F.col("text"))))

    within = pieces.where("closed AND goes_on = 0").select("_file", "_block", "piece", "text", "closed")
    crossing = pieces.where("NOT closed OR goes_on = 1")
    start = F.when(F.col("goes_on") == 0, F.struct("_block", "piece"))
    line = Window.partitionBy("_file").orderBy("_block", "piece").rowsBetween(Window.unboundedPreceding, 0)
    crossing = crossing.withColumn("start", F.last(start, True).over(line))
    joined = F.array_sort(F.collect_list(F.struct("_block", "piece", "text")))
    crossing = crossing.groupBy("_file", "start").agg(
        F.concat_ws("}", F.transform(joined, lambda x: x["text"])).alias("text"),
        F.max_by("closed", F.struct("_block", "piece")).alias("closed"),
    )
    crossing = crossing.select("_file", "start._block", "start.piece", "text", "closed")
    whole = within.unionByName(crossing)

    lead = F.when((F.col("_block") == 0) & (F.col("piece") == 0), r"^\s*\[").otherwise(r"^\s*,")
    # What a step names more than once is a column, so that it is worked out once.
    body = F.col("body")
    whole = whole.withColumn("body", F.when(F.col("closed"), F.col("text")).otherwise(F.regexp_replace("text", r"\]\s*$", "")))
    whole = whole.withColumn("body", F.when(body.rlike(r"^\s*$"), "").when(F.regexp_like(body, lead), F.regexp_replace(body, lead, F.lit(""))))
    whole = whole.withColumn("parsed", _closed(F.concat(F.lit("["), body, F.lit("]"))))
    whole = whole.withColumn("document", _opened(F.col("parsed")))
    whole = whole.select("_file", "_block", "piece", elements_of(F.col("document")).alias("elements"))
    # Blocks start at their byte and an element takes two bytes at least, so block + number orders a file's elements.
    whole = whole.withColumn("held", F.size("elements"))
    whole = whole.withColumn("_row_tag", F.col("_block") + _before("held", Window.partitionBy("_file", "_block").orderBy("piece")))
    # The inner generator would filter by the size of its array first, below the parser, which would run again for it.
    whole = whole.select("_file", "_row_tag", F.posexplode_outer("elements").alias("at", RECORD)).where("at IS NOT NULL")
    return whole.select("_file", (F.col("_row_tag") + F.col("at")).alias("_row_tag"), RECORD)


def scan_files(spark: SparkSession, files: Sequence[str], layout: str | None = None) -> DataFrame:
    """Records ``(_file, _row_tag, _record)`` of landed files (names of ``listed_files``), each in the layout it has.

    A file that starts with a bracket is one array, and its elements are the records; one that holds a single object
    is one record; any other holds a record per line. An array that does not close, or goes on
    after it closed, is one row with a NULL record, and so are an element or a line that cannot be parsed. Where
    ``layout`` is given, ``array`` or ``lines``, a file in the other one is rejected as a whole.
    """
    if layout not in (None, ARRAY, LINES):
        raise ValueError(f"unknown layout {layout!r}")
    out = spark.createDataFrame([], f"_file string, _row_tag long, {RECORD} variant")
    if not files:
        return out
    found: dict[str, set[str]] = {}
    rows = kept(_fragments(spark, files))
    blocks = kept(_blocks(rows))
    # One row a file at hand; the layouts decide how Spark is to read each.
    for name, has in blocks.select("_file", "layout").distinct().collect():
        has = BROKEN if layout and has in (ARRAY, LINES) and has != layout else has
        found.setdefault(has, set()).add(name)
    if ARRAY in found:
        out = out.unionByName(_array_records(rows, blocks))
    for has, whole in ((OBJECT, True), (LINES, False)):
        if has in found:
            raw = spark.read.format("text").option("wholetext", whole).load(_loadable(found[has]))
            out = out.unionByName(line_records(raw.select(F.col("_metadata.file_path").alias("_file"), "value")))
    if BROKEN in found:
        rejects = spark.createDataFrame([(f, 0) for f in sorted(found[BROKEN])], "_file string, _row_tag long")
        out = out.unionByName(rejects.withColumn(RECORD, F.lit(None).cast("variant")))
    return out
