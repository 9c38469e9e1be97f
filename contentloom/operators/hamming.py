"""Pairs of 64-bit fingerprints that differ in few bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 64


def _cuts(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """The range [low, high) in ``parts`` pieces of nearly equal size."""
    at = [low + (high - low) * i // parts for i in range(parts + 1)]
    return list(zip(at, at[1:], strict=False))


def _bits(value: Column, ranges: list[tuple[int, int]]) -> Column:
    """The bits of some ranges, in one number."""
    out = F.lit(0).cast("bigint")
    for low, high in ranges:
        mask = (1 << (high - low)) - 1
        piece = F.shiftrightunsigned(value, low).bitwiseAND(F.lit(mask))
        out = F.shiftleft(out, high - low).bitwiseOR(piece)
    return out


def block_keys(value: Column, distance: int) -> Column:
    """Keys of which two values at most ``distance`` bits apart share one.

    Of distance + 1 blocks one is equal. The other bits differ in as many places at most, so
    of distance + 1 blocks of them one is equal as well: a key is a block with a block of the
    rest. Values that are alike in one block, however many, are told apart by the second.
    """
    keys = []
    for i, (low, high) in enumerate(_cuts(0, BITS, distance + 1)):
        rest = [b for b in range(BITS) if not low <= b < high]
        for j, (a, z) in enumerate(_cuts(0, len(rest), distance + 1)):
            ranges = []
            for bit in rest[a:z]:
                if ranges and ranges[-1][1] == bit:
                    ranges[-1] = (ranges[-1][0], bit + 1)
                else:
                    ranges.append((bit, bit + 1))
            name = F.lit(i * (distance + 1) + j)
            keys.append(F.struct(name.alias("table"), _bits(value, [(low, high), *ranges]).alias("bits")))
    return F.array(*keys)


def clusters(df: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(value, n): the distinct fingerprints, and (key, value): their members. Rows of one
    fingerprint are never paired. NULL fingerprints are left out."""
    members = df.select(F.col(key), F.col(value).cast("bigint").alias("value")).filter("value IS NOT NULL")
    return members.groupBy("value").agg(F.count("*").alias("n")), members


def near_fingerprints(values: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b, distance): all pairs of distinct values at most ``distance`` bits apart, a < b.

    Values meet in the keys they share and are compared by the bits in which they differ.
    """
    if not 0 < distance < 8:
        raise ValueError("the distance must be from 1 to 7")
    keyed = values.select("value", F.explode(block_keys(F.col("value"), distance)).alias("k"))
    left, right = (keyed.select("k.*", F.col("value").alias(c)) for c in "ab")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    close = left.join(right, ["table", "bits"]).filter((F.col("a") < F.col("b")) & (apart <= distance))
    return close.select("a", "b").distinct().withColumn("distance", apart)
