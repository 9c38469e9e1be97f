"""Near-duplicate and exact fingerprints.

Hash family: 64 bits of md5, so that any SQL engine can recompute the values.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from contentloom.functions.core import col, let
from contentloom.functions.text import word_ngrams, word_string

SHINGLE_CHARS = 3
SHINGLE_WORDS = 3
HASHES_PER_SIDE = 6


def md5_text(c: Column) -> Column:
    return F.md5(c.cast("binary"))


def hash64(c: Column) -> Column:
    """First 64 bits of md5 as a signed long."""
    return F.conv(F.substring(md5_text(c), 1, 16), 16, -10).cast("bigint")


def char_shingles(body: Column | str) -> Column:
    """All 3-character windows of the lower-cased text (linear: one look-ahead scan)."""
    return F.regexp_extract_all(F.lower(col(body)), F.lit("(?s)(?=(.{3}))"), F.lit(1))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _distinct_char_shingles(lowered: pa.Array) -> pa.Array:
    shingles, ends, missing = [], [0], []
    for text in lowered:
        missing.append(not text.is_valid)
        points = np.frombuffer((text.as_py() or "").encode("utf-32-le"), "<u4").astype(np.uint64)
        if len(points) >= SHINGLE_CHARS:
            codes = np.unique(points[:-2] | (points[1:-1] << np.uint64(21)) | (points[2:] << np.uint64(42)))
            chars = np.stack([(codes >> np.uint64(s)) & np.uint64(0x1FFFFF) for s in (0, 21, 42)], axis=1).astype("<u4")
            if points.all():
                shingles += chars.view("<U3").ravel().tolist()
            else:  # numpy drops zeros at the end of its strings
                shingles += ["".join(map(chr, c)) for c in chars.tolist()]
        ends.append(len(shingles))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(shingles, pa.string()), mask=pa.array(missing))


def distinct_char_shingles(body: Column | str) -> Column:
    """``char_shingles`` without repetitions, in any order; for use outside of lambdas. A match
    and a string per character, as the regex makes them, cost several times as much."""
    return _distinct_char_shingles(F.lower(col(body)))


_EXTREMES = T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in ("low", "high")])


@F.arrow_udf(_EXTREMES)
def _extreme_shingle_hashes(lowered: pa.Array) -> pa.Array:
    sets, missing = [], []
    for text in lowered:
        missing.append(not text.is_valid)
        points = np.frombuffer((text.as_py() or "").encode("utf-32-le"), "<u4").astype(np.uint64)
        sets.append(np.unique(points[:-2] | (points[1:-1] << np.uint64(21)) | (points[2:] << np.uint64(42))))
    codes, places = np.unique(np.concatenate([np.array([], np.uint64), *sets]), return_inverse=True)
    shingles = ("".join(chr((c >> s) & 0x1FFFFF) for s in (0, 21, 42)) for c in codes.tolist())
    hashes = np.array([hashlib.md5(s.encode("utf-8")).hexdigest() for s in shingles], dtype="U32")
    order = np.argsort(hashes)
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.arange(len(order))
    hashes, ranks = hashes[order], ranks[places]
    low, high, start = [], [], 0
    for codes_of_text, absent in zip(sets, missing):
        own = np.sort(ranks[start : start + len(codes_of_text)])
        start += len(codes_of_text)
        low.append(None if absent else hashes[own[:HASHES_PER_SIDE]].tolist())
        high.append(None if absent else hashes[own[::-1][:HASHES_PER_SIDE]].tolist())
    lists = pa.list_(pa.string())
    return pa.StructArray.from_arrays([pa.array(low, lists), pa.array(high, lists)], ["low", "high"])


def minhash_pair(body: Column | str) -> Column:
    """struct<h1, h2>: hash of the six smallest and of the six largest shingle hashes.

    The texts of an Arrow batch share nearly all of their shingles, so that each is hashed
    once for the batch and a text only picks its extremes.
    """

    def fold(part: Column) -> Column:
        return hash64(F.array_join(part, ","))

    return let(
        _extreme_shingle_hashes(F.lower(col(body))),
        lambda h: F.struct(fold(h["low"]).alias("h1"), fold(h["high"]).alias("h2")),
    )


def sha1_hex(body: Column | str) -> Column:
    return F.upper(F.sha1(col(body).cast("binary")))


def _md5_bits(shingle: str) -> int:
    return int(hashlib.md5(shingle.encode("utf-8")).hexdigest()[:16], 16)


def _majority(hashes: np.ndarray, counts: np.ndarray) -> int:
    """Bit i of the result is set where more than half of the shingles have bit i."""
    bits = np.unpackbits(
        hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )
    wins = 2 * (counts @ bits.astype(np.int64)) > counts.sum()
    packed = np.packbits(wins.astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


@F.pandas_udf(T.LongType())
def _simhash_chars(lowered: pd.Series) -> pd.Series:
    seen: dict[int, int] = {}
    out = []
    for text in lowered:
        if text is None or len(text) < SHINGLE_CHARS:
            out.append(0)
            continue
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        codes = (
            points[:-2] | (points[1:-1] << np.uint64(21)) | (points[2:] << np.uint64(42))
        )
        distinct, counts = np.unique(codes, return_counts=True)
        for code in distinct.tolist():
            if code not in seen:
                chars = ((code >> shift) & 0x1FFFFF for shift in (0, 21, 42))
                seen[code] = _md5_bits("".join(map(chr, chars)))
        hashes = np.array([seen[c] for c in distinct.tolist()], dtype=np.uint64)
        out.append(_majority(hashes, counts))
    return pd.Series(out, dtype="int64")


@F.pandas_udf(T.LongType())
def _simhash_lists(shingles: pd.Series) -> pd.Series:
    out = []
    for items in shingles:
        if items is None or len(items) == 0:
            out.append(0)
            continue
        distinct, counts = np.unique(np.asarray(items, dtype=object), return_counts=True)
        hashes = np.array([_md5_bits(s) for s in distinct], dtype=np.uint64)
        out.append(_majority(hashes, counts))
    return pd.Series(out, dtype="int64")


def simhash_chars(body: Column | str) -> Column:
    """64-bit SimHash over 3-character shingles; every occurrence votes.

    The 64 counters of a row have no built-in form that stays in the row: exploding the
    shingles means regrouping, and joining back shuffles every text (measured: 10.6 s
    against 2.3 s here for 25 million shingles on 8 cores).
    """
    return _simhash_chars(F.lower(col(body)))


def simhash_words(body: Column | str) -> Column:
    """64-bit SimHash over 3-word shingles."""
    return _simhash_lists(word_ngrams(word_string(body), SHINGLE_WORDS))
