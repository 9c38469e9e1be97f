"""Entity mentions by gazetteer and by pattern, and the wide entity tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from contentloom.functions.core import comma_free_join, let
from contentloom.functions.text import word_ngrams
from contentloom.operators.lookup import BROADCAST_BYTES, lookup
from contentloom.session import cut_lineage

MONTHS = (
    "January|February|March|April|May|June|July|August|September|October|November|December"
)
# Patterns of the value-like types, the more telling first: a span has the type of the
# first that matches there. No look-around, so any regex engine runs them.
VALUE_PATTERNS = {
    "TIME": r"[0-9]{1,2}:[0-9]{2}(?: ?[ap]m)?",
    "DATE": rf"[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|(?:{MONTHS}) [0-9]{{1,2}}(?:, [0-9]{{4}})?",
    "PERCENT": r"[0-9]+(?:[.][0-9]+)?%",
    "MONEY": r"[$€£] ?[0-9]+(?:[.,][0-9]+)*",
    "ORDINAL": r"[0-9]+(?:st|nd|rd|th)|[Ff]irst|[Ss]econd|[Tt]hird",
    "QUANTITY": r"[0-9]+(?:[.][0-9]+)? ?(?:kg|km|cm|mm|miles|tons|liters)",
    "CARDINAL": r"[0-9]+",
}
# What a span of these patterns starts with, tested before the alternatives at every place.
VALUE_STARTS = "[0-9]|[$€£]|[JFMASOND][aepuco]|[Ff]ir|[Ss]ec|[Tt]hi"


def mention_words(body: Column | str) -> Column:
    """Words and numbers in their own case, joined by one space."""
    body = F.col(body) if isinstance(body, str) else body
    return F.trim(F.regexp_replace(body, r"[^\p{L}\p{N}]+", " "))


def candidate_mentions(
    docs: DataFrame, body: str, key: str = "id", lengths: Sequence[int] = (1, 2, 3, 4)
) -> DataFrame:
    """(id, start, length, mention): every run of as many words as ``lengths`` lists."""
    def spans(s: Column, n: int) -> Column:
        return F.transform(
            word_ngrams(s, n),
            lambda m, i: F.struct(
                i.alias("start"), F.lit(n).alias("length"), m.alias("mention")
            ),
        )

    all_spans = let(
        mention_words(body),
        lambda s: F.concat(*[spans(s, n) for n in lengths]),
    )
    return docs.select(key, F.explode(all_spans).alias("_m")).select(key, "_m.*")


def anchored_names(gazetteer: DataFrame) -> DataFrame:
    """(_anchor, _offset, _words, ent_type): every lower-cased name once per type, under that
    of its words which the fewest names have (of these the longest), so that a word looks up
    few names."""
    names = gazetteer.select(F.split(F.lower("mention"), " ").alias("_words"), "ent_type").distinct()
    each = names.select("_words", "ent_type", F.posexplode("_words").alias("_offset", "_anchor"))
    held = each.groupBy("_anchor").agg(F.count("*").alias("_names"))
    best = F.min_by(
        F.struct("_anchor", "_offset"), F.struct("_names", (-F.char_length("_anchor")).alias("l"), "_offset")
    )
    anchored = each.join(held, "_anchor").groupBy("_words", "ent_type").agg(best.alias("_best"))
    return cut_lineage(anchored.select("_best._anchor", "_best._offset", "_words", "ent_type"))


def anchor_words(docs: DataFrame, body: str, key: str, longest: int) -> DataFrame:
    """(id, pos, _anchor, near_start, near): every word, lower-cased, with the words that a
    name of up to ``longest`` words with it can cover."""

    def around(words: Column) -> Column:
        def one(word: Column, i: Column) -> Column:
            first = F.greatest(i - (longest - 1), F.lit(0))
            return F.struct(
                i.alias("pos"),
                F.lower(word).alias("_anchor"),
                first.alias("near_start"),
                F.slice(words, first + 1, i + longest - first).alias("near"),
            )

        return F.transform(words, one)

    spans = let(F.split(mention_words(body), " "), around)
    return docs.select(key, F.explode(spans).alias("_m")).select(key, "_m.*")


def gazetteer_mentions(
    docs: DataFrame,
    gazetteer: DataFrame,
    body: str = "body",
    key: str = "id",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, ent_type, pos, mention): longest gazetteer match per start word; matches
    inside an earlier one are dropped. ``gazetteer`` is (mention, ent_type).

    A text's words look up the names that they anchor, and the rest of a name is compared
    with the words around, inside the row: a text sends one row per word, however long and
    however many the names are.
    """
    names = anchored_names(gazetteer)
    longest = names.agg(F.max(F.size("_words"))).first()[0] or 1
    near = lookup(
        anchor_words(docs, body, key, longest), names, "_anchor", spread_by=key, max_bytes=max_bytes, materialized=True
    )
    begin = F.col("pos") - F.col("_offset")
    piece = F.slice("near", begin - F.col("near_start") + 1, F.size("_words"))
    found = (
        near.filter(begin >= F.col("near_start"))
        .select(key, "ent_type", "_words", begin.alias("start"), piece.alias("_piece"))
        .filter(F.transform("_piece", F.lower) == F.col("_words"))
        .select(key, "ent_type", "start", F.size("_words").alias("length"), F.array_join("_piece", " ").alias("mention"))
    )
    # Types of one span share its rank, so that an ambiguous name keeps all its types.
    w = Window.partitionBy(key).orderBy(F.asc("start"), F.desc("length"))
    return (
        found.withColumn("_end", F.col("start") + F.col("length"))
        .withColumn("_rank", F.dense_rank().over(w))
        .withColumn(
            "_reach",
            F.max("_end").over(
                Window.partitionBy(key)
                .orderBy("_rank")
                .rangeBetween(Window.unboundedPreceding, -1)
            ),
        )
        .filter(F.col("_reach").isNull() | (F.col("_end") > F.col("_reach")))
        .select(key, "ent_type", F.col("start").alias("pos"), "mention")
    )


def value_mentions(
    docs: DataFrame,
    body: str = "body",
    key: str = "id",
    patterns: Mapping[str, str] = VALUE_PATTERNS,
) -> DataFrame:
    """(id, ent_type, pos, mention) of numbers, dates, amounts and the like.

    One pass with the patterns as alternatives finds the spans; each gets one type, the
    first whose pattern is the whole span. Patterns other than the given ones are tried at
    every place, the given ones where ``VALUE_STARTS`` allows. ``pos`` counts the words before it, as for
    gazetteer mentions: the words between the spans and in them, added up in the order of
    the text. Only those numbers are shuffled, a window holds the spans of one text.
    """
    joined = "|".join(f"(?:{p})" for p in patterns.values())
    if patterns is VALUE_PATTERNS:
        joined = f"(?={VALUE_STARTS})(?:{joined})"
    count = lambda s: F.size(F.regexp_extract_all(s, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    gaps = F.transform(F.split(body, joined, -1), count)
    found = F.regexp_extract_all(F.col(body), F.lit(joined), F.lit(0))
    spans = docs.select(
        key, F.posexplode(F.arrays_zip(found.alias("m"), gaps.alias("g"))).alias("_i", "_s")
    ).select(key, "_i", F.col("_s.m").alias("mention"), F.col("_s.g").alias("_gap"))
    ent_type = F.lit(None).cast("string")
    for name, pattern in reversed(patterns.items()):
        ent_type = F.when(F.col("mention").rlike(f"^(?:{pattern})$"), name).otherwise(ent_type)
    order = Window.partitionBy(key).orderBy("_i")
    before = F.sum("_gap").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(
        F.sum("_inner").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        spans.filter("mention IS NOT NULL")
        .withColumn("_inner", count(F.col("mention")))
        .select(key, ent_type.alias("ent_type"), before.cast("int").alias("pos"), "mention")
    )


def entity_table(
    ids: DataFrame,
    mentions: DataFrame,
    types: Sequence[str],
    key: str = "id",
    first_seen: bool = True,
) -> DataFrame:
    """One row per id with a comma-joined column per type, '' where there is none.

    ``first_seen`` keeps the order of first occurrence, otherwise mentions are a sorted
    set. Repeated mentions collapse before the final grouping; ids without any mention
    ride along as empty rows instead of a second join.
    """
    wanted = mentions.filter(F.col("ent_type").isin(*types))
    distinct = wanted.groupBy(key, "ent_type", "mention").agg(F.min("pos").alias("pos"))
    blank = ids.select(
        key,
        F.lit(None).cast("string").alias("ent_type"),
        F.lit(None).cast("string").alias("mention"),
        F.lit(None).cast("int").alias("pos"),
    )
    entry = (
        F.struct("pos", "mention") if first_seen
        else F.struct("mention", "pos")
    )

    def column(ent_type: str) -> Column:
        listed = F.sort_array(F.collect_list(F.when(F.col("ent_type") == ent_type, entry)))
        return comma_free_join(F.transform(listed, lambda e: e["mention"])).alias(
            f"{ent_type.lower()}_entities"
        )

    return (
        distinct.unionByName(blank).groupBy(key).agg(*[column(t) for t in types])
    )
