"""A training-data pipeline over documents: each stage applies one operator and reads what the one before wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import document_key, free_name, shared_folder, spread_join
from tidemark.llm.language_id import UNKNOWN, add_languages
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.mixing import mix_sources
from tidemark.llm.packing import pack_documents
from tidemark.llm.near_dedup import drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, which becomes their lang; those without a letter go. Each row is judged by itself."""
    found = free_name(docs, "_found")
    known = add_languages(docs, found).filter(F.col(found)["lang_pred"] != UNKNOWN)
    return known.select(*[F.col(found)["lang_pred"].alias("lang") if c == "lang" else c for c in docs.columns])


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less their repeated lines; those of which nothing but blanks is left go."""
    lines = free_name(docs, "_lines")
    left = line_dedup(docs, prefix=lines)
    changed = F.col(lines)["n_exact"] + F.col(lines)["n_near"] > 0
    left = left.filter(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.select(*[F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else c for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8), the one with the smallest id; null ids come last."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as whole documents: each as many times as the schedule takes its words, to the nearest number.

    The schedule goes round each source, so one document of a source at most is taken in part. Rows that
    repeat id and text are taken alike.
    """
    keyed = docs.select(F.struct("*").alias("doc"), F.hex(document_key(F.col("doc_id"), F.col("text"))).alias("key"))
    taken, _ = mix_sources(keyed.select("key", "doc.text", "doc.source"), id_col="key")
    share = F.try_divide(F.sum("taken"), F.sum("size"))
    copies = taken.groupBy(F.col("doc_id").alias("key")).agg(F.floor(F.coalesce(share, F.lit(0)) + 0.5).cast("int").alias("copies")).filter("copies > 0")
    mixed = spread_join(keyed, copies, "key")
    return mixed.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("mix_sources", mix),
    ("pack", pack),
]

#: SQL has no suffix automata, XXH64 or tokenizers; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a Parquet table in the shared folder, which the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
