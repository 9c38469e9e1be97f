"""Fuzzy keyword matching: indel ratio 0..100 above a threshold."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from contentloom.operators.lookup import lookup

FUZZY_THRESHOLD = 90


#: Characters of a gram. Pads words to whole grams; no word has it.
GRAM, PAD = 3, "\x00"


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit per character of ``a``: as many steps
    as ``b`` has characters."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    whole = open_ = (1 << len(a)) - 1
    for c in b:
        hit = open_ & places.get(c, 0)
        open_ = (open_ + hit | open_ - hit) & whole
    return len(a) - open_.bit_count()


@F.pandas_udf(T.IntegerType())
def fuzzy_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 * 2 * (longest common subsequence) / (sum of the lengths), rounded."""
    return pd.Series(
        [
            100 if x == y else round(200 * _common_subsequence(x, y) / (len(x) + len(y)))
            for x, y in zip(a, b)
        ],
        dtype="int32",
    )


def _edit_share(threshold: int) -> float:
    """A rounded ratio above the threshold needs indel < share * (sum of the lengths)."""
    return 1 - (threshold + 0.5) / 100


def may_match(a: Column, b: Column, threshold: int = FUZZY_THRESHOLD) -> Column:
    """Native pre-filter; sound, because levenshtein is never above the indel distance."""
    total = F.char_length(a) + F.char_length(b)
    return F.levenshtein(a, b) < total * (1 - threshold / 100)


def _most_edits(length: int, threshold: int) -> tuple[int, int]:
    """The largest indel distance of a word of this length to any partner, and the length
    of its longest partner."""
    share = _edit_share(threshold)
    longest = max(n for n in range(length, 3 * length + 1) if n - length < share * (n + length))
    return math.ceil(share * (length + longest) + 1e-9) - 1, longest


def _shapes(max_len: int, threshold: int) -> list[dict]:
    """Per word length: the most edits to any partner, and the lengths of its partners."""
    out = []
    for n in range(1, max_len + 1):
        edits, longest = _most_edits(n, threshold)
        shortest = min(m for m in range(1, n + 1) if n - m < _edit_share(threshold) * (n + m))
        if -(-n // GRAM) <= edits:
            raise ValueError(f"words of {n} characters have fewer grams than edits at a ratio of {threshold}")
        out.append({"n": n, "edits": edits, "low": shortest, "high": longest})
    return out


def _grams(word: str, step: int) -> Column:
    """(place, gram) at every ``step``-th place of a word, the last ones padded."""
    padded = F.concat(F.col(word), F.lit(PAD * (GRAM - 1)))
    places = F.sequence(F.lit(0), F.char_length(F.col(word)) - 1, F.lit(step))
    return F.transform(places, lambda p: F.struct(p.alias("at"), padded.substr(p + 1, F.lit(GRAM)).alias("gram")))


def candidate_pairs(
    left: DataFrame, right: DataFrame, word: str = "word", threshold: int = FUZZY_THRESHOLD
) -> DataFrame:
    """Distinct (a, b) that pass the pre-filter, over the distinct words of both sides.

    ``a`` is cut into grams side by side. An edit spoils one of them, so of any d + 1 one is
    in ``b`` as it is, moved by d places at most. The d + 1 that are rarest in the other
    side's words are the keys of ``a``, all grams at all places those of ``b``; lengths and
    places are compared in the join. What very many words share is thus no key unless a
    word has little else. The keys of a word grow with its length. The table of shapes has
    a row per word length. Thresholds so low that a word has no d + 1 grams are refused.
    """
    a = left.select(F.col(word).alias("a")).filter("length(a) > 0").distinct()
    b = right.select(F.col(word).alias("b")).filter("length(b) > 0").distinct()
    longest = a.agg(F.max(F.char_length("a"))).first()[0] or 1
    shapes = left.sparkSession.createDataFrame(_shapes(longest, threshold), "n int, edits int, low int, high int")
    keys_b = b.select("b", F.inline(_grams("b", 1))).withColumnRenamed("at", "at_b")
    counted = keys_b.groupBy("gram").agg(F.count("*").alias("n"))
    cut = a.select("a", F.inline(_grams("a", GRAM)))
    rare = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "gram")))
    keys_a = (
        lookup(cut, counted, "gram", "a", how="left")
        .groupBy("a")
        .agg(rare.alias("grams"))
        .join(F.broadcast(shapes), F.char_length("a") == F.col("n"))
        .select("a", "edits", "low", "high", F.inline(F.slice("grams", 1, F.col("edits") + 1)))
        .drop("n")
    )
    length = F.char_length("b")
    near = (length >= F.col("low")) & (length <= F.col("high")) & (F.abs(F.col("at") - F.col("at_b")) <= F.col("edits"))
    close = keys_a.join(keys_b, "gram").filter(near & may_match(F.col("a"), F.col("b"), threshold))
    return close.select("a", "b").distinct()


def fuzzy_pairs(
    left: DataFrame, right: DataFrame, word: str = "word", threshold: int = FUZZY_THRESHOLD
) -> DataFrame:
    """(a, b, ratio) of all distinct word pairs whose ratio exceeds the threshold."""
    pairs = candidate_pairs(left, right, word, threshold)
    return pairs.withColumn("ratio", fuzzy_ratio("a", "b")).filter(F.col("ratio") > threshold)


def count_matches(
    left: DataFrame, right: DataFrame, word: str = "word", threshold: int = FUZZY_THRESHOLD
) -> DataFrame:
    """Number of matching (left row, right row) pairs, from counts per distinct word: the
    pairs themselves are never formed."""
    n_a = left.groupBy(F.col(word).alias("a")).agg(F.count("*").alias("n_a"))
    n_b = right.groupBy(F.col(word).alias("b")).agg(F.count("*").alias("n_b"))
    pairs = fuzzy_pairs(left, right, word, threshold)
    return pairs.join(n_a, "a").join(n_b, "b").agg(
        F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0)).alias("num_matches")
    )


def match_keyword_lists(
    df: DataFrame, key: str, words_1: str, words_2: str, threshold: int = FUZZY_THRESHOLD
) -> DataFrame:
    """(key, num_matches) for two keyword lists of the same row. Only pairs that pass the
    native pre-filter leave the row."""
    close = F.flatten(
        F.transform(
            words_1,
            lambda x: F.transform(
                F.filter(words_2, lambda y: may_match(x, y, threshold)),
                lambda y: F.struct(x.alias("a"), y.alias("b")),
            ),
        )
    )
    pairs = df.select(key, F.explode_outer(close).alias("_p")).select(
        key, F.coalesce("_p.a", F.lit("")).alias("a"), F.coalesce("_p.b", F.lit("-")).alias("b")
    )
    ratio = pairs.withColumn("_r", fuzzy_ratio("a", "b"))
    return ratio.groupBy(key).agg(F.count_if(F.col("_r") > threshold).alias("num_matches"))
