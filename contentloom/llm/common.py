"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from contentloom.session import scratch_table


#: Rows that Spark hands to Python at a time.
BATCH_ROWS = "2000"


def materialize(df: DataFrame, name: str, bucket_by: str | None = None) -> DataFrame:
    """Write a table into the shared folder and read it back.

    Later jobs read the files instead of repeating the work, and a lost executor costs the
    re-reading of its splits only. Batches for Python are kept small, as they hold texts.
    ``bucket_by`` names a column that later jobs group by, without another shuffle.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    table = scratch_table(df.sparkSession, name)
    writer = df.write.format("parquet")
    if bucket_by:
        writer = writer.bucketBy(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), bucket_by)
    writer.saveAsTable(table)
    for made in _COLLECTED:
        made.append(table)
    return df.sparkSession.table(table)


_COLLECTED: list[list[str]] = []


@contextmanager
def collected(made: list[str]) -> Iterator[None]:
    """Within, ``made`` gets the names of all tables that are materialized."""
    _COLLECTED.append(made)
    try:
        yield
    finally:
        _COLLECTED.remove(made)


def release(made: list[str], docs: DataFrame) -> None:
    """Drop the tables of ``made``, but for those that ``docs`` still reads."""
    files = docs.inputFiles()
    for table in list(made):
        if not any(f"/{table.split('.')[1]}/" in f for f in files):
            docs.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
            made.remove(table)


def id_part(id_col: str, parts: int) -> Column:
    """crc32 of the id's decimal digits, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string")) % parts


def is_part(id_col: str, parts: int, part: int) -> Column:
    """Whether a row falls into the part; a row without id falls into none."""
    return F.coalesce(id_part(id_col, parts) == part, F.lit(False))


def in_other_part(id_col: str, parts: int, part: int) -> Column:
    """Whether a row falls into any other part; a row without id falls into none."""
    return F.coalesce(id_part(id_col, parts) != part, F.lit(False))


def slim(df: DataFrame, **columns: str) -> DataFrame:
    """The columns an operator reads under its own names, so that further columns of the
    input cannot clash with the names it makes."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def require_whole_numbers(table: DataFrame, column: str) -> None:
    """Refuse ids of other types before a job starts."""
    kind = table.select(F.col(f"`{column}`")).schema[0].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{column} must be a whole number, not {kind.simpleString()}")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(
        text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def joined_digest(ids: Column) -> Column:
    """sha256 over the comma-joined strings of an array, lower-case hex."""
    return F.sha2(F.array_join(ids, ","), 256)


#: Size of a filter of hashes, as a power of two; the same for every table, unless a caller
#: knows better, false positives go at a later join.
FILTER_BITS = 24


def hash_filter(hashes: DataFrame, column: str, power: int = FILTER_BITS) -> bytes:
    """Two bits per 64-bit hash of a column, by its highest and its lowest bits: 2 MB, however
    many there are, or ``2**power`` bits."""
    high = F.shiftrightunsigned(column, 64 - power)
    low = F.col(column).bitwiseAND(F.lit((1 << power) - 1))
    places = hashes.select(F.explode(F.array(high, low)).alias("s")).select((F.col("s") + 1).alias("s"))
    parts = places.groupBy(F.bitmap_bucket_number("s").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits")
    )
    out = np.zeros(1 << (power - 3), np.uint8)
    for part in parts.collect():
        bits = np.frombuffer(part["bits"], np.uint8)
        out[(part["b"] - 1) * len(bits) : part["b"] * len(bits)] = bits
    return out.tobytes()


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which signed 64-bit hashes the filter may hold."""
    seen, power = np.ones(len(hashes), bool), len(bits).bit_length() + 2
    for places in (hashes.view(np.uint64) >> np.uint64(64 - power), hashes & ((1 << power) - 1)):
        places = places.astype(np.int64)
        seen &= (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)
    return seen


def batches_of(batch, size: int) -> Sequence:
    """Cut an Arrow batch into smaller ones, to bound what a task holds at a time."""
    return [batch.slice(i, size) for i in range(0, batch.num_rows, size)]
