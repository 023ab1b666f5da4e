"""From raw documents to packed training sequences: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm import decontaminate, ngram_join, packing, personal_data, quality
from cartloom.llm.queries import tokenizer_path
from cartloom.llm.store import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.good_documents(docs)


#: A row's name in the stages that decide by joining: equal for equal rows, and never null. Two different rows share one
#: with a chance of 2**-64.
ROW = "xxhash64(doc_id, text)"


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that reach each other by near-duplicate links, and of equal rows, the one with the smallest doc_id.

    Rows are judged one by one: ids may be null, or shared by rows of different texts.
    """
    named = docs.withColumn("_row", F.expr(ROW))
    found = ngram_join.near_duplicates(named.select(F.col("_row").alias("doc_id"), "text"))
    groups = found.groupBy(F.col("doc_id").alias("_row")).agg(F.min("component_id").alias("group"))
    ids = named.groupBy("_row").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    rows = written(ids.join(groups, "_row"))
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", "_row")).alias("first"))
    others = rows.join(first, "group").where(F.col("_row") != F.col("first._row")).select("_row")
    named = named.join(others, "_row", "left_anti")
    repeated = rows.where("copies > 1").select("_row")
    once = named.join(repeated, "_row", "left_anti")
    again = named.join(repeated, "_row", "left_semi")
    # A rank limit of one is also applied before the shuffle, so a task sends one of its equal rows.
    again = again.withColumn("_nth", F.row_number().over(Window.partitionBy("_row").orderBy("_row"))).where("_nth = 1")
    return once.select(docs.columns).unionByName(again.select(docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no window of words with a benchmark item, judged one by one."""
    named = docs.withColumn("_row", F.expr(ROW))
    found = decontaminate.decontaminate(named.select(F.col("_row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return named.join(found.where("contaminated").select(F.col("doc_id").alias("_row")), "_row", "left_anti").select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the personal data in them replaced by its kind."""
    return personal_data.mask_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of equal length."""
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("quality_rules", keep_good),
    ("ngram_join", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: No SQL: shingle components, the tagger and the tokenizer cannot be expressed in it. tests/llm checks `run` itself.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
