"""A training corpus from ``documents``: good texts in a known language, one of each near copy, no benchmarks, as tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from infield.llm import bpe, decontaminate, jaccard_join, language_id, quality
from infield.llm.common import MAX_BROADCAST_KEYS, scan, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text lies within their language's quantiles."""
    return quality.classify(docs, scan(spark, sf_dir, "labels"), only_kept=True).select(*COLUMNS)


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    models = language_id.train(docs.where(~language_id.held_out()).select("lang", "text"))
    return language_id.predict(docs, models, only_accepted=True).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies, once if its row is repeated; rows without an id stay."""
    found = jaccard_join.similar(docs).select("doc_id", "group_id").where("doc_id is not null")
    rows = stored(found.groupBy("doc_id").agg(F.min("group_id").alias("group_id"), F.count("*").alias("n")))

    def listed(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS else ids

    kept = docs.join(listed(rows.where("doc_id != group_id").select("doc_id")), "doc_id", "left_anti").select(*COLUMNS)
    repeated = rows.where("doc_id = group_id and n > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    repeated = listed(repeated)
    return kept.join(repeated, "doc_id", "left_anti").unionByName(kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark text."""
    return decontaminate.clean(docs, scan(spark, sf_dir, "benchmark")).select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_identification),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: The stages are models and iterations, which SQL doesn't express; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on the documents of ``sf_dir``, each written as Parquet and read again by the next."""
    docs = scan(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
