"""Text statistics, cleaning, tokens and per-row term counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contentloom.functions.core import col, computed_once, let, ratio


def ascii_words(body: Column | str) -> Column:
    """Runs of ASCII letters, as an array."""
    return F.regexp_extract_all(col(body), F.lit("[A-Za-z]+"), F.lit(0))


def general_tokens(body: Column | str) -> Column:
    """Runs of ASCII letters and digits; every non-ASCII character belongs to a token."""
    return F.regexp_extract_all(
        col(body), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"), F.lit(0)
    )


def word_string(body: Column | str) -> Column:
    """Lower-cased words of any script, joined by one space."""
    return F.trim(F.regexp_replace(F.lower(col(body)), r"[^\p{L}]+", " "))


def words(body: Column | str) -> Column:
    """Lower-cased words of any script, in order."""
    s = word_string(body)
    return F.filter(F.split(s, " ", -1), lambda w: w != F.lit(""))


def with_char_stats(df: DataFrame, body: str = "body") -> DataFrame:
    """Add the six length columns. One regex pass: the ASCII words joined by one space
    give both the token count (separators + 1) and the letter count."""
    letters = F.trim(F.regexp_replace(F.col(body), "[^A-Za-z]+", " "))
    joined = F.octet_length("_letters").cast("bigint")
    gaps = joined - F.octet_length(F.replace(F.col("_letters"), F.lit(" "), F.lit("")))
    return (
        computed_once(df, {"_letters": letters})
        .withColumns(
            {
                "alpha_token_count": F.when(F.col("_letters") == "", F.lit(0))
                .otherwise(gaps + 1)
                .cast("bigint"),
                "alpha_char_count": (joined - gaps).cast("bigint"),
                "total_char_count": F.octet_length(F.col(body)).cast("bigint"),
            }
        )
        .withColumn(
            "non_alpha_char_count", F.col("total_char_count") - F.col("alpha_char_count")
        )
        .withColumns(
            {
                "non_alpha_ratio": ratio(
                    F.col("non_alpha_char_count"), F.col("total_char_count")
                ),
                "alpha_ratio": ratio(F.col("alpha_char_count"), F.col("total_char_count")),
            }
        )
        .drop("_letters")
    )


def term_counts(terms: Column) -> Column:
    """array<struct<term, tf>> of an array of terms, inside the row.

    A document is one row, so its term frequencies need no shuffle: sort the terms, keep
    the start of every run, and a run's length is the distance to the next start.
    """

    def runs(s: Column) -> Column:
        positions = F.when(F.size(s) > 0, F.sequence(F.lit(0), F.size(s) - 1)).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(
            positions, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))
        )
        return let(
            starts,
            lambda st: F.transform(
                st,
                lambda p, j: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(st, j + 1), F.size(s)) - p).cast("bigint").alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(terms), runs)


def word_ngrams(joined_words: Column, n: int) -> Column:
    """Word n-grams of a space-joined word string; element i starts at word i."""
    if n == 1:
        return F.filter(F.split(joined_words, " ", -1), lambda w: w != F.lit(""))
    unit = " ".join(["[^ ]+"] * n)
    return F.regexp_extract_all(joined_words, F.lit(f"(?<![^ ])(?=({unit}))"), F.lit(1))


def clean_for_scoring(body: Column | str) -> Column:
    """Lower-case text without links, hashtags and punctuation.

    Line breaks and tabs go with the punctuation, so words next to them fuse. ``[^0-9A-Za-z ]``
    names the same characters, but Java takes about ten times as long for it.
    """
    t = F.lower(col(body))
    t = F.regexp_replace(t, r"http\S+", " ")
    t = F.regexp_replace(t, "#[A-Za-z0-9_]+", "")
    t = F.regexp_replace(t, r"[^\p{Alnum} ]+", "")
    return F.lower(F.regexp_replace(t, " +", " "))


def normalize_text(body: Column | str) -> Column:
    """White space and stray punctuation made regular before a model sees the text."""
    t = F.trim(F.regexp_replace(col(body), r"\s+", " "))
    t = F.regexp_replace(t, ". ,", "")
    for old, new in (("..", "."), (". .", "."), ("\n", ""), ("$.", "")):
        t = F.replace(t, F.lit(old), F.lit(new))
    return F.trim(t)


def truncate(body: Column | str, n: int) -> Column:
    """First n characters (code points): the model-input size limit of the pipeline."""
    return F.substring(col(body), 1, n)
