"""English-quality score from a word list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from contentloom.functions.text import clean_for_scoring, term_counts, truncate
from contentloom.operators.lookup import BROADCAST_BYTES, lookup
from contentloom.session import written

# Fixed value: the suggested pass mark.
TARGET_QUALITY_RATIO = 0.3


def english_quality(
    docs: DataFrame,
    vocabulary: DataFrame,
    body: str = "body",
    key: str = "id",
    lemmas: DataFrame | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, eng_quality): length of the known words, joined by spaces, over the length of
    the original text in characters; 0.0 for an empty text.

    ``vocabulary`` has a column ``word``; ``lemmas`` optionally maps token to lemma. Words
    are counted once, into a table; only ids, word counts and lengths are shuffled.
    """
    known = vocabulary.select(F.col("word").alias("token")).distinct()
    if lemmas is not None:
        by_lemma = lemmas.join(known.withColumnRenamed("token", "lemma"), "lemma", "left_semi")
        bare = known.join(lemmas.select("token"), "token", "left_anti")
        known = bare.unionByName(by_lemma.select("token")).distinct()

    tokens = F.filter(
        F.split(clean_for_scoring(body), " ", -1), lambda w: w != F.lit("")
    )
    counted = docs.select(key, F.char_length(body).alias("_chars"), term_counts(tokens).alias("_t"))
    rows = (
        written(counted, "quality_terms")
        .select(key, "_chars", F.explode_outer("_t").alias("_t"))
        .select(key, "_chars", F.col("_t.term").alias("token"), F.col("_t.tf").alias("tf"))
    )
    hits = lookup(
        rows, known.withColumn("_known", F.lit(1)), "token", spread_by=key, how="left",
        max_bytes=max_bytes, frequent_first=True,
    )
    n = F.when(F.col("_known") == 1, F.col("tf"))
    sums = hits.groupBy(key, "_chars").agg(
        F.sum(n * F.char_length("token")).alias("_letters"), F.sum(n).alias("_hits")
    )
    joined = F.coalesce(F.col("_letters") + F.col("_hits") - 1, F.lit(0))
    return sums.select(
        key,
        F.coalesce(F.try_divide(joined.cast("double"), F.col("_chars").cast("double")), F.lit(0.0))
        .alias("eng_quality"),
    )


def quality_rows(
    docs: DataFrame,
    scores: DataFrame,
    body: str = "body",
    key: str = "id",
    excerpt_chars: int | None = None,
) -> DataFrame:
    """Rows of the quality table: scores with the stored text (an excerpt if a length is
    given), time stamp and a flag."""
    stored = F.col(body) if excerpt_chars is None else truncate(body, excerpt_chars)
    return (
        docs.join(scores, key)
        .withColumn("content_short", stored)
        .withColumn("processed_at", F.current_timestamp())
        .withColumn("passes_target", F.col("eng_quality") >= TARGET_QUALITY_RATIO)
        .drop(body)
    )
