"""Vector similarity joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from contentloom.functions.vectors import cosine_similarity
from contentloom.operators.keyed import first_per_key, top_k_per_key
from contentloom.operators.lookup import lookup


def most_similar_per_group(
    vectors: DataFrame, key: str, vector: str, group: str, k: int
) -> DataFrame:
    """The k vectors of each group closest to the group's reference vector (smallest key).

    One comparison per vector: the reference table has one row per group and is looked up
    with hot groups salted; each task keeps k rows of a group before the shuffle.
    """
    refs = first_per_key(vectors.select(group, key, vector), [group], [key]).select(
        group, F.col(key).alias("ref_id"), F.col(vector).alias("_ref")
    )
    scored = (
        lookup(vectors, refs, group, spread_by=key)
        .filter(F.col(key) != F.col("ref_id"))
        .select(
            group, "ref_id", key,
            F.round(cosine_similarity(vector, "_ref"), 6).alias("similarity"),
        )
    )
    return top_k_per_key(scored, [group], [F.desc("similarity"), F.asc(key)], k)


def pair_similarity(pairs: DataFrame, vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Cosine of given (left_id, right_id) pairs."""
    left = vectors.select(F.col(key).alias("left_id"), F.col(vector).alias("_l"))
    right = vectors.select(F.col(key).alias("right_id"), F.col(vector).alias("_r"))
    return pairs.join(left, "left_id").join(right, "right_id").select(
        "left_id", "right_id", cosine_similarity("_l", "_r").alias("similarity")
    )
