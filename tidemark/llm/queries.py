"""The registered queries of the corpus operators: each runs its operator over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, filter_audit, language_id, line_dedup, lm_scoring, mixing, nearest, packing, quality, simhash, source_audit, suffix_dedup, topk
from .common import documents, free_name


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(documents(spark, sf_dir))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    lines = free_name(docs, "_lines")
    out = line_dedup.line_dedup(docs, prefix=lines)
    return out.select("doc_id", f"{lines}.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, _ = mixing.mix_sources(documents(spark, sf_dir))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir))


def op9_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept", "spans")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.source_divergence(documents(spark, sf_dir))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_quality,
        op3_exact_dedup,
        op4_lm_scoring,
        op5_simhash,
        op6_top_k,
        op7_line_dedup,
        op8_mix_sources,
        op9_pack_documents,
        op10_suffix_dedup,
        op11_source_audit,
        op12_filter_audit,
        op13_nearest,
    )
}
#: Where SQL can express a query over the whole table in reasonable time; the others are tested against brute force.
ORACLES = {
    "op3_exact_dedup": exact_dedup.SQL,
    "op6_top_k": topk.SQL,
    "op7_line_dedup": line_dedup.SQL,
    "op8_mix_sources": mixing.SQL,
    "op11_source_audit": source_audit.SQL,
    "op12_filter_audit": filter_audit.SQL,
    "op13_nearest": nearest.SQL,
}
