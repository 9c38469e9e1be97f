"""Usage analytics, duplicate audits and table reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from contentloom.functions.core import matching_patterns, readable_bytes
from contentloom.session import scratch_table


def monthly_activity(df: DataFrame, ts: str, actor: str) -> DataFrame:
    """Rows and distinct actors per calendar month.

    Rows are reduced to one per (month, actor) first: the distinct count is then a plain
    sum, and a single busy month is spread over its actors.
    """
    month = F.date_trunc("month", F.col(ts)).cast("date")
    per_actor = df.groupBy(month.alias("month"), F.col(actor).alias("_actor")).agg(
        F.count("*").alias("_n")
    )
    return per_actor.groupBy("month").agg(
        F.sum("_n").alias("transactions"),
        F.count("_actor").alias("monthly_active_users"),
    )


def actor_counts(df: DataFrame, actor: str) -> DataFrame:
    return df.groupBy(actor).agg(F.count("*").alias("cnt"))


def count_histogram(df: DataFrame, actor: str) -> DataFrame:
    """How many actors have each row count."""
    return actor_counts(df, actor).groupBy("cnt").agg(F.count("*").alias("n_actors"))


def actor_quantiles(df: DataFrame, actor: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Exact quantiles of rows per actor, from the counts-of-counts histogram, which is
    small (its counts sum up to the number of rows) where the actors are not."""
    hist = count_histogram(df, actor)
    return hist.agg(
        *[
            F.percentile("cnt", F.lit(q), F.col("n_actors")).alias(name)
            for name, q in quantiles.items()
        ]
    )


def actors_with_count(df: DataFrame, actor: str, n: int) -> DataFrame:
    return actor_counts(df, actor).filter(F.col("cnt") == n).select(actor)


def rows_of_actors_with_count(df: DataFrame, actor: str, n: int) -> DataFrame:
    """All rows of the actors that have exactly n rows."""
    return df.join(actors_with_count(df, actor, n), actor, "left_semi")


def distinct_counts(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Row count and exact distinct count of several columns in one pass."""
    named = df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    )
    return named.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.countDistinct(n).alias(f"distinct_{n}") for n in columns],
    )


def duplicate_clusters(df: DataFrame, fingerprint: str, body: str) -> DataFrame:
    """Size and longest text (bytes) per fingerprint."""
    return df.groupBy(fingerprint).agg(
        F.count("*").alias("n"), F.max(F.octet_length(body)).cast("bigint").alias("longest")
    )


def coverage(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct ids per enrichment table, one labelled row each."""
    parts = [
        t.agg(F.countDistinct(key).alias("n_ids")).withColumn("label", F.lit(label))
        for label, (t, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def storage_report(tables: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Bytes, oldest and newest date per table, largest first.

    File sizes come from the scan's own metadata columns: one row per file after the first
    aggregate, whatever the row count.
    """
    parts = []
    for name, (df, ts) in tables.items():
        day = F.to_date(ts) if ts else F.lit(None).cast("date")
        files = df.groupBy(F.col("_metadata.file_path").alias("_path")).agg(
            F.max("_metadata.file_size").alias("_bytes"),
            F.min(day).alias("_lo"),
            F.max(day).alias("_hi"),
        )
        parts.append(
            files.agg(
                F.sum("_bytes").alias("size"),
                F.min("_lo").alias("min_date"),
                F.max("_hi").alias("max_date"),
            ).withColumn("table", F.lit(name))
        )
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("size_readable", readable_bytes("size"))
        .orderBy(F.desc("size"), "table")
    )


def outcome_tally(df: DataFrame, ok: Column) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
    )


def keep_successes_or_fail(df: DataFrame, ok: Column) -> DataFrame:
    """Keep the successes of a batch; refuse the batch when failures outnumber them.

    The batch is evaluated once: both outcomes are counted while the successes are written
    to a staged table, which is dropped if the batch is refused.
    """
    spark, counts = df.sparkSession, Observation()
    good = F.coalesce(ok, F.lit(False))
    staged = scratch_table(spark, "successes")
    observed = df.observe(counts, F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"))
    observed.filter(good).write.format("parquet").saveAsTable(staged)
    tally = counts.get
    if tally["failed"] > tally["succeeded"]:
        spark.sql(f"DROP TABLE {staged}")
        raise ValueError(
            f"too many failures: {tally['failed']} failed, {tally['succeeded']} succeeded"
        )
    return spark.table(staged)


def topic_search(
    df: DataFrame, body: str, patterns: Sequence[str], match_all: bool
) -> DataFrame:
    """Rows whose text matches all (or any) of the patterns, with their positions."""
    wanted = len(patterns) if match_all else 1
    return df.withColumn("matches", matching_patterns(body, patterns)).filter(
        F.size("matches") >= wanted
    )
