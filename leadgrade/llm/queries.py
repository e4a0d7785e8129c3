"""The queries of this subpackage and the SQL that must agree, where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrade.llm import (
    cascade,
    clusters,
    decontaminate,
    extract,
    lang_id,
    line_dedup,
    mixing,
    near_dup,
    negatives,
    oracles,
    passages,
    quality,
    tokens,
    top_k,
)

QUERIES, ORACLES = {}, {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by compression with learned dictionaries."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lang_id.learn(docs)
    found = lang_id.identify(docs.drop("lang"), model)
    return found.select(
        "doc_id",
        lang_id.held_out(found.doc_id).alias("held_out"),
        "lang_pred",
        "score",
        "margin",
        "rejected",
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the share that it holds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    return tokens.document_token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector with all others."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract(pages, extract.learn(pages))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, text=False).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under ProbMinHash near-duplicate search."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from the labels of its lines."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, _table(spark, sf_dir, "labels"))
    found = quality.score(docs, model)
    return found.select("doc_id", quality.held_out(found.doc_id).alias("held_out"), "score", "predicted")


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of every document that other documents have too."""
    return passages.repeated_passages(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without recurring lines, and how many went."""
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every fiftieth vector that score close below its positives."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", moved)
    return negatives.hard_negatives(vectors, vectors.where("vec_id % 50 = 0"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds over sixteen centroids."""
    return clusters.cluster(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, and whether the cascade of rules keeps it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return cascade.assess(docs).select("doc_id", *cascade.BASE, "base_failed", "kept")


QUERIES |= {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_html_extraction": op5_html_extraction,
    "op6_source_mixing": op6_source_mixing,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_line_quality": op8_line_quality,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_line_dedup": op10_line_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_quality_rules": op13_quality_rules,
}

ORACLES |= {
    "op2_decontamination": oracles.DECONTAMINATION,
    "op4_exact_top_k": oracles.TOP_K,
    "op10_line_dedup": oracles.LINE_DEDUP,
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
    "op12_centroid_clusters": oracles.CLUSTERING,
    "op13_quality_rules": oracles.QUALITY_RULES,
}
