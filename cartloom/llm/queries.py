"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import corpus_model, decontaminate, html_text, importance, licenses, ngram_join, packing, personal_data, prefix_trie
from . import quality, secrets, sharding, suffix_dedup
from .oracles import ORACLES  # noqa: F401
from .store import table


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_corpus_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_model.score_documents(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_personal_data,
    op2_license_scan,
    op3_packing,
    op4_ngram_join,
    op5_quality_rules,
    op6_decontamination,
    op7_suffix_dedup,
    op8_secret_scan,
    op9_sharding,
    op10_html_extraction,
    op11_importance_resampling,
    op12_prefix_trie,
    op13_corpus_model,
)}
