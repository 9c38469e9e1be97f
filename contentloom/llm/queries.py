"""One registered query per operator, with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from contentloom.llm import oracles
from contentloom.llm.common import ascii_lower, is_part
from contentloom.llm.decontamination import decontaminate
from contentloom.llm.language_id import identify_languages
from contentloom.llm.language_model import score_texts
from contentloom.llm.lexical import rank_documents
from contentloom.llm.line_dedup import kept_text, line_bitmaps
from contentloom.llm.merkle import merkle_manifest
from contentloom.llm.near_dedup import near_duplicates
from contentloom.llm.packing import pack_documents
from contentloom.llm.quality import score_quality
from contentloom.llm.revisits import captures_of, resolve_revisits
from contentloom.llm.secrets import find_secrets
from contentloom.llm.topk import top_k
from contentloom.llm.urls import filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> dict[str, str]:
    """The public vocabulary as a tokenizer file and, for speed, as ranks."""
    return {
        "tokenizer_path": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_revisits(captures_of(_table(spark, sf_dir, "pages")))
    line = F.transform("headers", lambda h: F.concat_ws("=", h["name"], h["value"]))
    return resolved.withColumn("headers", F.array_join(line, ";"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), **tokenizer_files())


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents")).drop("secret_spans")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return filter_urls(_table(spark, sf_dir, "pages"), labels, bad)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    altered = F.when(is_part("doc_id", 3, 0), ascii_lower(text)).otherwise(text)
    return merkle_manifest(_table(spark, sf_dir, "documents"), altered={"text": altered})


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_bitmaps(_table(spark, sf_dir, "documents"), keep=["text"])
    kept = F.sha2(kept_text(F.col("text"), F.col("bitmap")), 256)
    return judged.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run  # it builds on this module

    return run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_url_filter": op1_url_filter,
    "op2_language_id": op2_language_id,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality": op4_quality,
    "op5_revisits": op5_revisits,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_packing": op7_packing,
    "op8_topk": op8_topk,
    "op9_secrets": op9_secrets,
    "op10_decontamination": op10_decontamination,
    "op11_lexical_search": op11_lexical_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_line_dedup": op13_line_dedup,
}
ORACLES = {
    "op5_revisits": oracles.OP5,
    "op8_topk": oracles.OP8,
    "op9_secrets": oracles.OP9,
    "op11_lexical_search": oracles.OP11,
    "op12_merkle_manifest": oracles.OP12,
    "op13_line_dedup": oracles.OP13,
}
