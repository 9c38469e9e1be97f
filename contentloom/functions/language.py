"""Language mix of a text from function-word profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from contentloom.functions.core import col, let, ratio
from contentloom.functions.text import words

PROFILE_WORDS = 40
MAX_LANGUAGES = 1_000

Profile = dict[str, list[str]]


def profile_table(labelled: DataFrame, text: str, lang: str, k: int = PROFILE_WORDS) -> DataFrame:
    """(lang, token): the k most frequent words per language that no other language shares.

    Counting is combined on the map side, and the top-k filter runs in every task before
    the shuffle, so a language with a third of the corpus costs no more than any other.
    """
    counts = (
        labelled.select(F.col(lang).alias("lang"), F.explode(words(text)).alias("token"))
        .groupBy("lang", "token")
        .agg(F.count("*").alias("n"))
    )
    rank = F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("token"))
    )
    top = counts.withColumn("rank", rank).filter(F.col("rank") <= k)
    return (
        top.groupBy("token")
        .agg(F.count("*").alias("languages"), F.min("lang").alias("lang"))
        .filter(F.col("languages") == 1)
        .select("lang", "token")
    )


def collect_profile(table: DataFrame) -> Profile:
    """At most k words per language by construction; more languages than any corpus has
    point to a wrong label column and are refused before they reach the driver."""
    if table.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is this a language column?")
    profile: Profile = {}
    for row in table.orderBy("lang", "token").collect():
        profile.setdefault(row["lang"], []).append(row["token"])
    return profile


def language_mix(body: Column | str, profile: Profile, top: int | None = None) -> Column:
    """map<language, share> of all languages found, or of the ``top`` strongest.

    Two set look-ups per word inside the row: no shuffle of the text. The first keeps the
    words any profile knows, the second counts each language among those.
    """
    known = sorted({w for ws in profile.values() for w in ws})
    if not known:
        return F.create_map().cast("map<string,double>")

    def hits_in(hits: Column, vocabulary: list[str]) -> Column:
        return F.size(F.filter(hits, lambda w: w.isin(vocabulary)))

    def mix(hits: Column) -> Column:
        shares = F.array(
            *[
                F.struct(
                    (-ratio(hits_in(hits, ws), F.size(hits))).alias("order"),
                    F.lit(lang).alias("lang"),
                )
                for lang, ws in sorted(profile.items())
            ]
        )
        present = F.sort_array(F.filter(shares, lambda s: s["order"] < 0))
        return F.map_from_entries(
            F.transform(
                present if top is None else F.slice(present, 1, top),
                lambda s: F.struct(s["lang"], -s["order"]),
            )
        )

    return let(F.filter(words(col(body)), lambda w: w.isin(known)), mix)
