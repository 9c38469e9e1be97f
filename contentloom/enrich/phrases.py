"""Key phrases, hashed vectors, extractive summaries and titles, style profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contentloom.functions.core import col, let
from contentloom.functions.fingerprint import md5_text
from contentloom.functions.text import normalize_text, words
from contentloom.operators.keyed import top_k_per_key
from contentloom.operators.lookup import BROADCAST_BYTES
from contentloom.operators.terms import (
    contending_terms,
    doc_terms,
    sentences,
    stored_doc_terms,
    stored_sentence_terms,
    term_stats,
    with_idf,
)

KEY_PHRASES = 5
SUMMARY_SENTENCES = 3
TITLE_WORDS = 8
EMBEDDING_DIM = 64


def keyphrases(
    docs: DataFrame,
    n_docs: int,
    body: str = "body",
    key: str = "id",
    k: int = KEY_PHRASES,
    max_bytes: int = BROADCAST_BYTES,
    corpus: DataFrame | None = None,
) -> DataFrame:
    """(id, keywords): the k best one- and two-word phrases by TF-IDF, best first; '' for a
    text without words, so that it counts as done.

    Scores are rounded before ranking, so that ties are ties on every engine. ``corpus`` has
    the texts whose ``n_docs`` give the statistics, if these are not ``docs``.
    """
    if corpus is None:
        terms, stats = contending_terms(docs, body, n_docs, k, ngrams=(1, 2), key=key, max_bytes=max_bytes)
    else:
        terms, seen = (doc_terms(d, body, ngrams=(1, 2), key=key) for d in (docs, corpus))
        stats = term_stats(seen, n_docs)
    made = corpus is None
    scored = with_idf(terms, stats, key, max_bytes, stored=made, materialized=made).withColumn(
        "score", F.round(F.col("tf") * F.col("idf"), 6)
    )
    top = top_k_per_key(
        scored.select(key, "term", "score"), [key], [F.desc("score"), F.asc("term")], k
    )
    blank = docs.select(key, F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("term"))
    found = F.when(F.col("rank").isNotNull(), F.struct("rank", "term"))
    listed = F.sort_array(F.collect_list(found))
    return top.select(key, "rank", "term").unionByName(blank).groupBy(key).agg(
        F.array_join(F.transform(listed, lambda e: e["term"]), ",").alias("keywords")
    )


def hashed_embeddings(
    docs: DataFrame,
    n_docs: int,
    body: str = "body",
    key: str = "id",
    dim: int = EMBEDDING_DIM,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, embedding): TF-IDF weights added up in hashed, signed slots, L2-normalised; zeros
    for a text without words.

    A task adds up its terms before the shuffle, to at most ``dim`` slots a text.
    """
    ready = docs.select(key, normalize_text(body).alias("_text"))
    terms = stored_doc_terms(ready, "_text", key=key)
    weighted = with_idf(terms, term_stats(terms, n_docs), key, max_bytes)
    digest = md5_text(F.col("term"))
    slot = F.pmod(
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(dim)
    ).cast("int")
    sign = F.when(F.substring(digest, 9, 1) < "8", F.lit(1.0)).otherwise(F.lit(-1.0))
    slots = (
        weighted.select(
            key, slot.alias("slot"), (sign * F.col("tf") * F.col("idf")).alias("w")
        )
        .unionByName(docs.select(key, F.lit(0).alias("slot"), F.lit(0.0).alias("w")))
        .groupBy(key, "slot")
        .agg(F.sum("w").alias("w"))
    )
    sparse = slots.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "w"))).alias("_m"),
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"),
    )
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: F.coalesce(
            F.try_divide(F.try_element_at(F.col("_m"), i), F.col("_norm")), F.lit(0.0)
        ),
    )
    return sparse.select(key, dense.alias("embedding"))


def sentence_scores(
    docs: DataFrame,
    n_docs: int,
    body: str = "body",
    key: str = "id",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, pos, score): mean IDF of the words of each sentence; no sentence text moves."""
    per_sentence, terms = stored_sentence_terms(docs, body, key)
    weighted = with_idf(per_sentence, term_stats(terms, n_docs), key, max_bytes)
    return weighted.groupBy(key, "pos").agg(
        F.round(
            F.sum(F.col("tf") * F.col("idf")) / F.sum("tf").cast("double"), 6
        ).alias("score")
    )


def _best_positions(scores: DataFrame, key: str, k: int) -> DataFrame:
    top = top_k_per_key(scores, [key], [F.desc("score"), F.asc("pos")], k)
    return top.groupBy(key).agg(F.sort_array(F.collect_list("pos")).alias("_best"))


def summaries(
    docs: DataFrame,
    n_docs: int,
    body: str = "body",
    key: str = "id",
    k: int = SUMMARY_SENTENCES,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, summary): the k best sentences in text order; '' for a text without words."""
    best = _best_positions(sentence_scores(docs, n_docs, body, key, max_bytes), key, k)
    picked = let(
        sentences(body), lambda ss: F.transform("_best", lambda p: F.get(ss, p))
    )
    return docs.select(key, body).join(best, key, "left").select(
        key, F.coalesce(F.array_join(picked, " "), F.lit("")).alias("summary")
    )


def titles(
    docs: DataFrame,
    n_docs: int,
    body: str = "body",
    key: str = "id",
    n_words: int = TITLE_WORDS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, title): the first words of the best sentence."""
    best = _best_positions(sentence_scores(docs, n_docs, body, key, max_bytes), key, 1)
    sentence = let(sentences(body), lambda ss: F.get(ss, F.get("_best", F.lit(0))))
    cut = F.array_join(F.slice(F.split(sentence, " +", -1), 1, n_words), " ")
    return docs.select(key, body).join(best, key, "left").select(
        key, F.coalesce(cut, F.lit("")).alias("title")
    )


def style_profile(docs: DataFrame, body: str = "body", key: str = "id") -> DataFrame:
    """(id, measures, style): all measures of a text come from its own row."""
    t = col(body)
    chars = F.char_length(t).cast("double")

    def count_of(pattern: str) -> Column:
        return F.size(F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).cast("double")

    base = docs.select(key, body, words(t).alias("_w"), F.size(sentences(t)).alias("_n"))
    measured = base.select(
        key,
        F.size("_w").cast("bigint").alias("n_words"),
        F.col("_n").cast("bigint").alias("n_sentences"),
        F.round(F.try_divide(F.size("_w").cast("double"), F.col("_n").cast("double")), 6)
        .alias("mean_sentence_words"),
        F.round(
            F.try_divide(
                F.char_length(F.array_join("_w", "")).cast("double"),
                F.size("_w").cast("double"),
            ),
            6,
        ).alias("mean_word_chars"),
        F.round(
            F.try_divide(
                F.size(F.array_distinct("_w")).cast("double"), F.size("_w").cast("double")
            ),
            6,
        ).alias("type_token_ratio"),
        F.round(F.try_divide(count_of(r"[?]"), F.col("_n").cast("double")), 6).alias("question_rate"),
        F.round(F.try_divide(count_of("!"), F.col("_n").cast("double")), 6).alias("exclamation_rate"),
        F.round(F.try_divide(count_of("[0-9]"), chars), 6).alias("digit_rate"),
    )
    style = (
        F.when(F.col("n_words") == 0, "empty")
        .when(F.col("digit_rate") > 0.05, "technical")
        .when(F.col("question_rate") > 0.3, "inquiring")
        .when(F.col("exclamation_rate") > 0.3, "emphatic")
        .when(F.col("mean_sentence_words") > 25, "elaborate")
        .when(F.col("mean_sentence_words") < 8, "terse")
        .otherwise("neutral")
    )
    return measured.withColumn("style", style)
