"""The corpus pipeline: quality, near-duplicates, benchmark leaks, secrets, packing.

A stage's result is written before the next stage starts, which then drops the tables that
the earlier ones have made on the way and its documents do not read.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from contentloom.llm.common import collected, materialize, release
from contentloom.llm.decontamination import drop_contaminated
from contentloom.llm.near_dedup import keep_one_each
from contentloom.llm.packing import pack_documents
from contentloom.llm.quality import score_quality
from contentloom.llm.queries import tokenizer_files
from contentloom.llm.secrets import find_secrets, redact


_MADE: list[str] = []


def _stage(fn):
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(_MADE, docs)
        with collected(_MADE):
            return fn(spark, docs, sf_dir)

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_quality(docs, labels, keep=docs.columns)
    return scored.filter("predicted = 1").select(*docs.columns)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return keep_one_each(docs, percent=80)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by its kind's placeholder."""
    found = find_secrets(docs, keep=docs.columns)
    text = redact(F.col("text"), F.col("secret_spans"))
    changed = F.size("secret_spans") > 0
    replaced = {"text": text}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return found.withColumns(replaced).select(*docs.columns)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return pack_documents(docs, **tokenizer_files())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: Learned scores and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each over what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        with collected(_MADE):
            docs = materialize(out, f"stage_{name}")
    result, made = docs, [t for t in _MADE if "stage_packing" not in t]
    _MADE.clear()
    release(made, result)
    return result
