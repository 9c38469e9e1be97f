"""Unified content, quality gate and near-duplicate removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from contentloom.functions.core import computed_once
from contentloom.functions.fingerprint import minhash_pair, simhash_chars
from contentloom.functions.language import Profile, language_mix
from contentloom.functions.text import with_char_stats
from contentloom.operators.lookup import fits_broadcast
from contentloom.session import written
from contentloom.sources.payloads import CONTENT_FIELDS

# Fixed values of the quality gate.
MAX_NON_ALPHA_RATIO = 0.25
MIN_TOKENS = 30
MIN_TOKENS_CYBERCONNECT = 300
MIN_ENGLISH_SHARE = 0.9
VOTE_PHRASE = "%i just voted%"


def with_gate_stats(df: DataFrame, profile: Profile, body: str = "body") -> DataFrame:
    """The statistics that the gate and the near-duplicate key need, row by row.

    Filters on the length columns run before the language mix, and filters on that before
    the MinHash pair.
    """
    mixed = computed_once(
        with_char_stats(df, body), {"languages": language_mix(body, profile)}
    )
    return mixed.withColumn("ngram_min_hash", minhash_pair(body))


def with_text_stats(df: DataFrame, profile: Profile, body: str = "body") -> DataFrame:
    """All statistics columns of a content table."""
    return with_gate_stats(df, profile, body).withColumn("ngram_hash", simhash_chars(body))


def content_union(frames: list[DataFrame]) -> DataFrame:
    """Per-application frames stacked into the common columns."""
    common = ["id", "created_at", *CONTENT_FIELDS, "retrieved_at", "app"]
    return reduce(DataFrame.unionByName, [f.select(*common) for f in frames])


def english_share(languages: str = "languages") -> Column:
    return F.coalesce(F.try_element_at(F.col(languages), F.lit("en")), F.lit(0.0))


def app_rule() -> Column:
    """Extra rule per application; others pass."""
    return (
        F.when(F.col("app") == "lens", ~F.col("body").ilike(VOTE_PHRASE))
        .when(F.col("app") == "cyberconnect", F.col("alpha_token_count") > MIN_TOKENS_CYBERCONNECT)
        .otherwise(F.lit(True))
    )


def quality_gate() -> Column:
    return (
        (F.col("non_alpha_ratio") < MAX_NON_ALPHA_RATIO)
        & (F.col("alpha_token_count") > MIN_TOKENS)
        & (english_share() > MIN_ENGLISH_SHARE)
        & app_rule()
    )


def strict_quality_gate() -> Column:
    """The form whose vote rule has no default: it keeps rows of ``lens`` only."""
    return (
        (F.col("non_alpha_ratio") < MAX_NON_ALPHA_RATIO)
        & F.when(F.col("app") == "lens", ~F.col("body").ilike(VOTE_PHRASE))
        & F.when(
            F.col("app") == "cyberconnect",
            F.col("alpha_token_count") > MIN_TOKENS_CYBERCONNECT,
        ).otherwise(F.col("alpha_token_count") > MIN_TOKENS)
        & (english_share() > MIN_ENGLISH_SHARE)
    )


def gated(content: DataFrame, app: str = "any") -> DataFrame:
    """Rows that pass the gate, of one application or of any."""
    rows = content if app == "any" else content.filter(F.col("app") == app)
    return rows.filter(quality_gate())


def quality_content(content: DataFrame, app: str = "any") -> DataFrame:
    """Gate first, then the earliest row of every near-duplicate key.

    Give it ``with_gate_stats`` and add the SimHash to the survivors: whatever the rows
    carry is computed before they are compared. The rows that pass are written once. Only
    keys, times and ids are compared, and the winners' numbers go back to the texts, which
    stay where they are if the measured size of the numbers allows it.
    """
    number = F.monotonically_increasing_id().alias("_row")
    passed = gated(content, app).withColumn("ngram_min_1", F.col("ngram_min_hash.h1"))
    stored = written(passed.select("*", number), "gated")
    first = stored.groupBy("ngram_min_1").agg(F.min(F.struct("retrieved_at", "id", "_row")).alias("_first"))
    winners = written(first.select("_first._row"), "winners")
    winners = F.broadcast(winners) if fits_broadcast(winners) else winners
    return stored.join(winners, "_row", "left_semi").drop("_row")


def counts_by_app(content: DataFrame) -> DataFrame:
    """(app, before_dedupe, after_dedupe) in one pass: only the keys and the order columns
    are shuffled, and a key's list has one entry per application."""
    keys = gated(content).select(
        F.col("ngram_min_hash.h1").alias("h1"), "retrieved_at", "id", "app"
    )
    per_app = keys.groupBy("h1", "app").agg(
        F.count("*").alias("n"), F.min(F.struct("retrieved_at", "id")).alias("first")
    )
    per_key = per_app.groupBy("h1").agg(
        F.min_by("app", "first").alias("winner"),
        F.collect_list(F.struct("app", "n")).alias("apps"),
    )
    return (
        per_key.select("winner", F.explode("apps").alias("a"))
        .groupBy(F.col("a.app").alias("app"))
        .agg(
            F.sum("a.n").alias("before_dedupe"),
            F.count_if(F.col("winner") == F.col("a.app")).alias("after_dedupe"),
        )
    )
