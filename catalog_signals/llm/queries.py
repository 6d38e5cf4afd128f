"""The operators over the whole test tables, and SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_signals.llm.divergence import divergence
from catalog_signals.llm.embedding_dedup import near_duplicates
from catalog_signals.llm.line_dedup import dedup_lines
from catalog_signals.llm.mixing import mixture
from catalog_signals.llm.ngram_join import jaccard_join
from catalog_signals.llm.packing import Packing, pack
from catalog_signals.llm.passages import repeated_passages
from catalog_signals.llm.periodic_runs import periodic_runs
from catalog_signals.llm.quality_classifier import quality
from catalog_signals.llm.quality_rules import quality_rules
from catalog_signals.llm.sharding import shard
from catalog_signals.llm.text import table
from catalog_signals.llm.toxicity import toxicity
from catalog_signals.llm.url_filters import filter_urls


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels carry ids only; the label of id i is taken as the outcome of page i."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    judged = filter_urls(table(spark, sf_dir, "pages"), outcomes)
    figures = [F.round(c, 6).alias(c) for c in ("mean", "bound")]
    return judged.select("page_id", "host", "path", "rule", "verdict", *figures)


def packing_parameters() -> Packing:
    import public_tokenizers

    return Packing(public_tokenizers.path("word_bpe_49k.json"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), packing_parameters())


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard(table(spark, sf_dir, "documents"))
    return sharded.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("removed_words")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), planting=True)


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_url_filters": op3_url_filters,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_sharding": op7_sharding,
    "op8_mixing": op8_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_quality_classifier": op13_quality_classifier,
}
