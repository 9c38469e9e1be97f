"""One row per key, top rows per key, and global row numbers, without hot groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from contentloom.session import cut_lineage


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    row = pick(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("_row")).select("_row.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest order columns of every key.

    An aggregate, not a window: each task sends at most one row per key, so a key that
    holds a third of all rows is reduced before the shuffle instead of filling one task.
    """
    return _one_per_key(df, keys, order, F.min_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest order columns of every key (keyed-replace semantics)."""
    return _one_per_key(df, keys, order, F.max_by)


def top_k_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The k first rows of every key, ranked from 1.

    Spark cuts each task's share of a key to k rows before the shuffle
    (WindowGroupLimit), so large keys stay cheap.
    """
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, n).filter(F.col(rank) <= k)


def with_ordinal(df: DataFrame, key: str, name: str = "ordinal") -> DataFrame:
    """0-based global position by a unique key, without a global window.

    Ranges of the key, as many as the session has shuffle partitions, are numbered apart
    and start where the ranges before them end. The ranges are written once, since the
    bounds of a repeated range partitioning may differ. One window sees the ranges' sizes:
    a row per shuffle partition.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(
        df.repartitionByRange(max(2, parts), key).withColumn("_bucket", F.spark_partition_id())
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_bucket")
        .agg(F.count("*").alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    return (
        ranged.withColumn("_local", local)
        .join(offsets, "_bucket")
        .withColumn(name, (F.col("_offset") + F.col("_local")).cast("bigint"))
        .drop("_bucket", "_local", "_offset")
    )


def batch_plan(
    df: DataFrame, key: str, batch_size: int, max_batches: int | None = None
) -> DataFrame:
    """Number all rows by a unique key into batches of ``batch_size``.

    ``max_batches`` asks for the first batches only, where a run should take no more.
    """
    batch = F.floor(F.col("_position") / batch_size).cast("bigint")
    planned = with_ordinal(df, key, "_position").withColumn("batch_id", batch).drop("_position")
    return planned if max_batches is None else planned.filter(F.col("batch_id") < max_batches)
