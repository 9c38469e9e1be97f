"""Mergeable sketches: statistics of any range of days without its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: log2 of the registers of a distinct count; its standard error is about 1.04 / 2^(n / 2).
LG_REGISTERS = 12
#: Size of a quantile sketch; the rank of an answer is right to about 1 %.
QUANTILE_K = 400


def daily_sketches(
    df: DataFrame, ts: str, actor: str, value: str, *by: str, lg: int = LG_REGISTERS, k: int = QUANTILE_K
) -> DataFrame:
    """One row per day (and ``by``): rows, sum, a sketch of the distinct actors, one of the
    values (whole numbers). Rows without time are left out; NULL actors and values count in
    no sketch. Sketches of a day are built in every task and merged after it."""
    number = F.col(value).cast("bigint")
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.to_date(ts).alias("day"), *by)
        .agg(
            F.count("*").alias("n"),
            F.sum(number).alias("total"),
            F.hll_sketch_agg(actor, lg).alias("actors"),
            F.kll_sketch_agg_bigint(number, k).alias("amounts"),
        )
    )


def merged(daily: DataFrame, *by: Column | str) -> DataFrame:
    """The same for coarser groups, from the daily rows alone."""
    return daily.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.hll_union_agg("actors").alias("actors"),
        F.kll_merge_agg_bigint("amounts").alias("amounts"),
    )


def figures(sketched: DataFrame, **quantiles: float) -> DataFrame:
    """Estimates in place of the sketches: ``n_actors`` and a column per quantile, NULL for a
    group without values."""
    keys = [c for c in sketched.columns if c not in ("actors", "amounts")]
    some = F.kll_sketch_get_n_bigint("amounts") > 0
    return sketched.select(
        *keys,
        F.hll_sketch_estimate("actors").alias("n_actors"),
        *[F.when(some, F.kll_sketch_get_quantile_bigint("amounts", F.lit(q))).alias(n) for n, q in quantiles.items()],
    )
