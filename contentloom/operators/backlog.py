"""Which rows still have to be processed, and in what portion."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contentloom.functions.fingerprint import md5_text
from contentloom.operators.keyed import first_per_key
from contentloom.session import cut_lineage
from contentloom.sources.tables import append


def not_done(source: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows without a partner in the done table."""
    return source.join(done.select(*keys), list(keys), "left_anti")


def missing_partner(source: DataFrame, files: DataFrame, key: str, payload: str) -> DataFrame:
    """Rows whose payload is absent or empty. Written as an anti join against the
    non-empty payloads, so neither payload text nor unmatched rows travel."""
    present = files.filter(F.coalesce(F.col(payload), F.lit("")) != "").select(key)
    return source.join(present, key, "left_anti")


def stage_flags(source: DataFrame, stages: Mapping[str, DataFrame], key: str = "id") -> DataFrame:
    """Add ``has_<stage>`` (0/1) per enrichment stage.

    The stage tables are stacked and reduced to one row per id first, so the source, which
    carries the text, joins once instead of once per stage.
    """
    stacked = reduce(
        DataFrame.unionByName,
        [t.select(F.col(key), F.lit(name).alias("_stage")) for name, t in stages.items()],
    )
    flags = stacked.groupBy(key).agg(
        *[F.max((F.col("_stage") == name).cast("int")).alias(f"has_{name}") for name in stages]
    )
    joined = source.join(flags, key, "left")
    return joined.withColumns(
        {f"has_{name}": F.coalesce(F.col(f"has_{name}"), F.lit(0)) for name in stages}
    )


def any_pending(flagged: DataFrame, stages: Sequence[str]) -> DataFrame:
    names = [f"has_{s}" for s in stages]
    lowest = F.least(*names) if len(names) > 1 else F.col(names[0])
    return flagged.filter(lowest == 0)


def pending_for(flagged: DataFrame, stage: str) -> DataFrame:
    return flagged.filter(F.col(f"has_{stage}") == 0)


def run_pending(
    source: DataFrame,
    stages: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]],
    key: str = "id",
) -> dict[str, int]:
    """Run every stage on the rows its table lacks and append the results.

    ``stages`` maps a name to its table and its function. The flags of all stages come from
    one stacked aggregate. A stage without pending rows is skipped. Returns the number of
    rows appended per stage; a second run appends none.
    """
    spark = source.sparkSession
    tables = {name: spark.table(table) for name, (table, _) in stages.items()}
    flags = stage_flags(source.select(key), tables, key)
    flags = cut_lineage(any_pending(flags, list(stages)))
    added = {}
    for name, (table, enrich) in stages.items():
        pending = pending_for(flags, name).select(key)
        if pending.isEmpty():
            added[name] = 0
            continue
        rows = cut_lineage(enrich(source.join(pending, key, "left_semi")))
        append(rows, table)
        added[name] = rows.count()
    return added


def random_subset(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """n random rows; each task keeps its own n smallest draws only."""
    return df.orderBy(F.rand(seed)).limit(n)


def hash_ordered_subset(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """A subset that looks random but is the same in every run."""
    text = F.concat(F.lit(seed), F.col(key).cast("string"))
    return df.orderBy(md5_text(text), F.col(key)).limit(n)


def backlog(
    source: DataFrame,
    done: DataFrame,
    keys: Sequence[str],
    limit: int | None = None,
    seed: int | None = None,
    distinct_on: str | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Anti join, optional one-row-per-id, then a random portion of the whole backlog."""
    todo = not_done(source, done, keys)
    if distinct_on:
        todo = first_per_key(todo, [distinct_on], order or [distinct_on])
    return random_subset(todo, limit, seed) if limit is not None else todo


def hash_sample(df: DataFrame, key: str, about: int, total: int, parts: int = 65536) -> DataFrame:
    """About ``about`` of ``total`` rows, always the same ids: rows whose key hashes below
    the matching share. A per-row test; no shuffle, no sort."""
    keep = min(parts, -(-parts * about // max(total, 1)))
    return df.filter(F.pmod(F.xxhash64(key), F.lit(parts)) < keep)


def md5_sample(df: DataFrame, key: str, about: int, total: int, parts: int = 65536) -> DataFrame:
    """``hash_sample`` with a hash other engines can recompute."""
    keep = min(parts, -(-parts * about // max(total, 1)))
    bucket = F.conv(F.substring(md5_text(F.col(key).cast("string")), 1, 4), 16, 10)
    return df.filter(bucket.cast("int") < keep)


def missing_heights(
    spark: SparkSession, stored: DataFrame, upper: int, height: str, limit: int | None = None
) -> DataFrame:
    """Integers below ``upper`` with no stored row, ascending."""
    wanted = spark.range(upper).select(F.col("id").alias("height"))
    have = stored.select(F.col(height).cast("bigint").alias("height"))
    gaps = wanted.join(have, "height", "left_anti").orderBy("height")
    return gaps.limit(limit) if limit is not None else gaps


def newer_than_max(source: DataFrame, target: DataFrame, ts: str, keep: Column | None = None) -> DataFrame:
    """Source rows newer than the newest target row (all rows for an empty target),
    AND the keep rule as one bracketed condition."""
    mark = target.agg(F.max(ts)).scalar()
    fresh = mark.isNull() | (F.col(ts) > mark)
    return source.filter(fresh & keep if keep is not None else fresh)


def newer_than_max_or_listed(source: DataFrame, target: DataFrame, ts: str, search: Column, listed: Column) -> DataFrame:
    """The unbracketed form ``newer AND search OR listed``: listed rows ignore the mark."""
    mark = target.agg(F.max(ts)).scalar()
    return source.filter(((F.col(ts) > mark) & search) | listed)
