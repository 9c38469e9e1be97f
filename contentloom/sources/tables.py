"""Reading and writing tables: append, keyed replace, delete, rebuild, export."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from contentloom.operators.keyed import latest_per_key
from contentloom.session import cut_lineage


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def to_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The columns of a table schema in order and type; a missing one is an error."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the table: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_clustered(
    df: DataFrame, table: str, keys: Sequence[str], partition_by: Sequence[str] = ()
) -> None:
    """Create or replace a table whose files hold ranges of the sort key."""
    order = [*partition_by, *keys]
    writer = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format("parquet").saveAsTable(table)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Create or replace a table bucketed and sorted by its join key. Tables with the same
    buckets (payload cache, index, content, enrichment tables) join without a shuffle."""
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .format("parquet")
        .saveAsTable(table)
    )


def append(df: DataFrame, table: str) -> None:
    """Append, projected to the columns of the table, into its partitions and buckets."""
    to_schema(df, df.sparkSession.table(table).schema).write.insertInto(table)


@dataclass(frozen=True)
class Layout:
    """How the files of a table are laid out."""

    partition_by: tuple[str, ...] = ()
    buckets: int = 0
    bucket_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()


def layout_of(spark: SparkSession, table: str) -> Layout:
    """Partition, bucket and sort columns as the catalog has them."""
    parts = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    facts = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    names = lambda key: tuple(re.findall("`([^`]+)`", facts.get(key) or ""))
    return Layout(
        parts, int(facts.get("Num Buckets") or 0), names("Bucket Columns"), names("Sort Columns")
    )


def rebuild_and_swap(df: DataFrame, table: str, layout: Layout | None = None) -> None:
    """Write the new contents in the table's own layout, then take the name over.

    The old table stays readable until the new one is complete, and may be the input of
    ``df``. It is renamed before the new one takes its name and dropped last, so that a run
    that dies in between leaves a whole table: under its name or as ``<table>_replaced``.
    """
    spark = df.sparkSession
    layout = layout or layout_of(spark, table)
    staged, replaced = f"{table}_rebuilt", f"{table}_replaced"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    spark.sql(f"DROP TABLE IF EXISTS {replaced}")
    if layout.buckets:
        df = df.repartition(layout.buckets, *layout.bucket_by)
    writer = df.write.format("parquet")
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    if layout.buckets:
        writer = writer.bucketBy(layout.buckets, *layout.bucket_by)
        if layout.sort_by:
            writer = writer.sortBy(*layout.sort_by)
    writer.saveAsTable(staged)
    for name, new_name in ((table, replaced), (staged, table)):
        partitioned = any(c.isPartition for c in spark.catalog.listColumns(name))
        spark.sql(f"ALTER TABLE {name} RENAME TO {new_name}")
        if partitioned:  # the catalog may still have the folders of the former name
            spark.sql(f"MSCK REPAIR TABLE {new_name} SYNC PARTITIONS")
    spark.sql(f"DROP TABLE {replaced}")
    spark.catalog.refreshTable(table)


def _newest(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key; of equal order values the inserted row wins."""
    both = old.withColumn("_fresh", F.lit(0)).unionByName(new.withColumn("_fresh", F.lit(1)))
    return latest_per_key(both, keys, [*order, "_fresh"]).select(*old.columns)


def keyed_replace(
    new: DataFrame, table: str, keys: Sequence[str], order: Sequence[str]
) -> None:
    """Insert rows so that the newest row of every key survives; replays change nothing."""
    old = new.sparkSession.table(table)
    rebuild_and_swap(_newest(old, new.select(*old.columns), keys, order), table)


def overwrite_partitions(rows: DataFrame, table: str) -> None:
    """Replace the partitions that ``rows`` has rows of; the others stay as they are.

    ``rows`` may read the table: they are written apart first.
    """
    spark = rows.sparkSession
    merged = cut_lineage(rows.select(*spark.table(table).columns))
    # The writer option is not read for catalog tables; the session setting is.
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        merged.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def keyed_replace_partitions(
    new: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], day: str
) -> None:
    """``keyed_replace`` for a table partitioned by ``day``, which must be part of the key:
    only the partitions that receive rows are read and rewritten."""
    if day not in keys:
        raise ValueError("the partition column must be part of the key")
    spark = new.sparkSession
    old = spark.table(table)
    fresh = cut_lineage(new.select(*old.columns))
    touched = [r[0] for r in fresh.select(day).distinct().collect()]
    same_days = old.filter(F.col(day).isin(touched))
    overwrite_partitions(_newest(same_days, fresh, keys, order), table)


def deduplicate(table: str, spark: SparkSession, columns: Sequence[str]) -> None:
    """Keep one row per combination of the columns."""
    rebuild_and_swap(spark.table(table).dropDuplicates(list(columns)), table)


def delete_where(table: str, spark: SparkSession, condition: Column) -> None:
    """Delete the rows for which the condition is true; unknown (NULL) rows stay.

    Of a partitioned table, only partitions with such rows are rewritten, or dropped if no
    row stays; nothing is written where no row matches.
    """
    rows, gone = spark.table(table), F.coalesce(condition, F.lit(False))
    parts = layout_of(spark, table).partition_by
    hit = [tuple(r) for r in rows.filter(gone).select(*parts).distinct().collect()] if parts else []
    if parts and not hit:
        return
    if not parts or any(v is None for values in hit for v in values):
        rebuild_and_swap(rows.filter(~gone), table)
        return
    same = lambda values: reduce(Column.__and__, [F.col(c) == F.lit(v) for c, v in zip(parts, values, strict=True)])
    kept = cut_lineage(rows.filter(reduce(Column.__or__, map(same, hit)) & ~gone))
    left = {tuple(r) for r in kept.select(*parts).distinct().collect()}
    overwrite_partitions(kept, table)
    for values in set(hit) - left:
        spec = ", ".join(f"`{c}` = '{v}'" for c, v in zip(parts, values, strict=True))
        spark.sql(f"ALTER TABLE {table} DROP PARTITION ({spec})")
    spark.catalog.refreshTable(table)


def export_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
