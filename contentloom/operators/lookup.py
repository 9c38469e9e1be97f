"""Joins of very many rows to one row per key, where some keys are hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from contentloom.session import cut_lineage

BROADCAST_BYTES = 32 << 20
ROW_OVERHEAD = 24


def _bytes_of(value: Column, kind: T.DataType) -> Column:
    """About what a value takes in memory; NULL takes nothing."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
            size = F.aggregate(
                value, F.lit(0).cast("long"), lambda n, e: n + 8 + _bytes_of(e, kind.elementType).cast("long")
            )
        else:
            size = F.size(value) * 8
    elif isinstance(kind, T.StructType):
        size = sum((_bytes_of(value[f.name], f.dataType) for f in kind), F.lit(8))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("long"), F.lit(0))


def _row_bytes(df: DataFrame) -> Column:
    return sum((_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(ROW_OVERHEAD))


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's values, summed up where they are."""
    return df.agg(F.sum(_row_bytes(df))).first()[0] or 0


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    weight: str | None = None,
    max_bytes: int = BROADCAST_BYTES,
    materialized: bool = False,
    frequent_first: bool = False,
) -> DataFrame:
    """Join facts to a dimension on ``key``.

    A dimension whose measured size allows it is broadcast. Beyond that both sides are
    shuffled. Keys with more than a task's share of the facts are salted, into as many
    parts as they have such shares: their facts are dealt by the hash of ``spread_by`` and
    only their dimension rows are copied. At most a key per shuffle partition can be that
    hot, so the list of hot keys is small by construction. ``weight`` names the dimension
    column that holds the fact count of a key; without it the facts are counted.

    ``frequent_first`` is for words and the like, whose counts are very unequal: the rows of
    the most frequent keys are broadcast, as many as the size allows, so that most facts stay
    where they are and only the facts of the other keys are shuffled. The facts are then read
    up to three times, so they should come from a table.

    The check, the frequent keys and the join read the dimension, so it is written once,
    unless the caller has ``materialized`` it.
    """
    if not materialized:
        dim = cut_lineage(dim)
    if fits_broadcast(dim, max_bytes):
        return facts.join(F.broadcast(dim), key, how)
    if frequent_first and weight is None:
        counted = _counts(facts, key).join(dim, key, how)
        return lookup(
            facts, counted, key, spread_by, how, "_n", max_bytes, frequent_first=True
        ).drop("_n")
    least = least_frequent(dim, weight, max_bytes) if frequent_first else None
    if least is None:
        return _salted(facts, dim, key, spread_by, how, weight)
    is_frequent = F.coalesce(F.col(weight) >= least, F.lit(False))
    frequent = F.broadcast(cut_lineage(dim.filter(is_frequent)))
    others = facts.join(frequent, key, "left_anti")
    return facts.join(frequent, key).unionByName(
        _salted(others, dim.filter(~is_frequent), key, spread_by, how, weight)
    )


def _counts(facts: DataFrame, key: str) -> DataFrame:
    return facts.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col(key).isNotNull())


def least_frequent(dim: DataFrame, weight: str, max_bytes: int) -> int | None:
    """The least power of two such that the rows of at least this weight fit ``max_bytes``."""
    by_power = (
        dim.filter(F.col(weight) > 0)
        .groupBy(F.floor(F.log2(weight)).alias("power"))
        .agg(F.sum(_row_bytes(dim)).alias("bytes"))
    )
    least = None
    for row in by_power.orderBy(F.desc("power")).collect():
        max_bytes -= row["bytes"]
        if max_bytes < 0:
            break
        least = 2 ** row["power"]
    return least


def _salted(
    facts: DataFrame, dim: DataFrame, key: str, spread_by: str, how: str, weight: str | None
) -> DataFrame:
    counts = (
        dim.select(key, F.col(weight).alias("_n")).filter(F.col(key).isNotNull())
        if weight
        else _counts(facts, key)
    )
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    share = max(1, total // parts)
    hot = cut_lineage(
        counts.filter(F.col("_n") > share).select(key, F.ceil(F.col("_n") / share).alias("_parts"))
    )
    one = F.lit(1).cast("bigint")
    salted_facts = (
        facts.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.coalesce("_parts", one)))
        .drop("_parts")
    )
    salted_dim = (
        dim.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(one - 1, F.coalesce("_parts", one) - 1)))
        .drop("_parts")
    )
    return salted_facts.join(salted_dim, [key, "_salt"], how).drop("_salt")
