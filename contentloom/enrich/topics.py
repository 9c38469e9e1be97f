"""Topic scores from weighted seed terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contentloom.functions.core import let
from contentloom.operators.lookup import BROADCAST_BYTES, lookup
from contentloom.operators.terms import doc_terms, stored_doc_terms
from contentloom.schemas import TOPIC_LABELS
from contentloom.session import cut_lineage

# Fixed value: a label counts as a topic above this score.
TOPIC_THRESHOLD = 0.7


def topic_scores(
    docs: DataFrame,
    seeds: DataFrame,
    n_docs: int,
    body: str = "body",
    key: str = "id",
    labels: Sequence[str] = TOPIC_LABELS,
    max_bytes: int = BROADCAST_BYTES,
    corpus: DataFrame | None = None,
) -> DataFrame:
    """(id, categories, top_categories, categories_over_threshold).

    ``seeds`` is (label, term, weight). Labels are scored independently of each other with
    1 - exp(-sum(weight * share of the term in the text * idf)). ``corpus`` has the texts
    whose ``n_docs`` give the statistics, if these are not ``docs``.
    """
    terms = (stored_doc_terms if corpus is None else doc_terms)(docs, body, key=key)
    seeds = cut_lineage(seeds)
    seed_terms = seeds.select("term").distinct()
    seen = terms if corpus is None else doc_terms(corpus, body, key=key)
    df = lookup(seen, seed_terms, "term", spread_by=key, max_bytes=max_bytes).groupBy(
        "term"
    ).agg(F.count("*").alias("df"))
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    by_term = (
        seeds.join(df, "term")
        .groupBy("term")
        .agg(
            *[
                F.sum(
                    F.when(F.col("label") == label, F.col("weight") * idf).otherwise(0.0)
                ).alias(f"_w{i}")
                for i, label in enumerate(labels)
            ]
        )
    )
    blank = docs.select(
        key, F.lit("").alias("term"), F.lit(0).cast("bigint").alias("tf"),
        F.lit(1).cast("bigint").alias("n_terms"),
    )
    hits = lookup(terms, by_term, "term", spread_by=key, max_bytes=max_bytes)
    with_all = hits.unionByName(blank, allowMissingColumns=True)
    share = F.col("tf") / F.col("n_terms")
    sums = with_all.groupBy(key).agg(
        *[
            F.sum(F.coalesce(F.col(f"_w{i}"), F.lit(0.0)) * share).alias(f"_s{i}")
            for i in range(len(labels))
        ]
    )
    entries = F.array(
        *[
            F.struct(
                (F.lit(1.0) - F.exp(-F.col(f"_s{i}"))).alias("score"),
                F.lit(label).alias("label"),
            )
            for i, label in enumerate(labels)
        ]
    )
    return sums.select(
        key,
        F.map_from_entries(
            F.transform(entries, lambda e: F.struct(e["label"], e["score"]))
        ).alias("categories"),
    ).withColumns(
        {
            "top_categories": top_category("categories"),
            "categories_over_threshold": categories_over("categories"),
        }
    )


def ranked_labels(categories: Column | str) -> Column:
    """Entries by falling score, ties by label."""
    entries = F.map_entries(categories)
    ordered = F.sort_array(
        F.transform(
            entries, lambda e: F.struct((-e["value"]).alias("o"), e["key"].alias("label"))
        )
    )
    return F.transform(
        ordered, lambda e: F.struct(e["label"].alias("label"), (-e["o"]).alias("score"))
    )


def top_category(categories: Column | str, threshold: float = TOPIC_THRESHOLD) -> Column:
    """Only the best label is tested against the threshold; '' otherwise."""
    return let(
        ranked_labels(categories),
        lambda r: F.when(
            F.get(r, F.lit(0))["score"] > threshold, F.get(r, F.lit(0))["label"]
        ).otherwise(F.lit("")),
    )


def categories_over(categories: Column | str, threshold: float = TOPIC_THRESHOLD) -> Column:
    """All labels over the threshold, best first, comma-joined."""
    over = F.filter(ranked_labels(categories), lambda e: e["score"] > threshold)
    return F.array_join(F.transform(over, lambda e: e["label"]), ",")
