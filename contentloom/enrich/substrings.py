"""Substring search over an inverted index of character trigrams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from contentloom.enrich.postings import POSTINGS_PER_BLOCK, find_all_stored, posting_blocks, write_posting_blocks
from contentloom.functions.core import exploded
from contentloom.functions.fingerprint import SHINGLE_CHARS, distinct_char_shingles
from contentloom.operators.lookup import fits_broadcast


def write_substring_index(
    docs: DataFrame, table: str, body: str = "body", key: str = "id", buckets: int = 256, block: int = POSTINGS_PER_BLOCK
) -> None:
    """Store the lower-cased trigrams of every whole text as posting blocks of ids (whole
    numbers). A text sends each of its trigrams once; no text is shuffled."""
    grams = exploded(docs, [key], distinct_char_shingles(body), "term")
    write_posting_blocks(posting_blocks(grams, key, block), table, buckets)


def _grams(docs: DataFrame, pattern: str) -> list[str]:
    """The trigrams of a pattern as Spark lower-cases them."""
    return docs.sparkSession.range(1).select(distinct_char_shingles(F.lit(pattern))).first()[0]


def candidates(
    docs: DataFrame, stored: DataFrame, patterns: Sequence[str], match_all: bool, key: str = "id", buckets: int = 256
) -> DataFrame:
    """The documents that can hold all, or any, of the patterns in whatever case.

    A text with a pattern has all the pattern's trigrams, so these are searched as a
    conjunction in the stored blocks. Patterns of fewer characters exclude nothing: among
    all patterns they are left out, among alternatives they make every document a
    candidate. Only the candidates' rows leave the scan.
    """
    grams = [_grams(docs, p) for p in patterns]
    if match_all:
        wanted = sorted({g for gs in grams for g in gs})
        if not wanted:
            return docs
        ids = find_all_stored(stored, wanted, buckets, key)
    else:
        if any(len(p) < SHINGLE_CHARS for p in patterns):
            return docs
        found = [find_all_stored(stored, gs, buckets, key) for gs in grams]
        if not found:
            return docs.limit(0)
        ids = reduce(DataFrame.union, found).distinct()
    return docs.join(F.broadcast(ids) if fits_broadcast(ids) else ids, key, "left_semi")


def containing(
    docs: DataFrame,
    stored: DataFrame,
    patterns: Sequence[str],
    match_all: bool,
    body: str = "body",
    key: str = "id",
    buckets: int = 256,
    ignore_case: bool = True,
) -> DataFrame:
    """Documents whose text contains all, or any, of the patterns: candidates of the index,
    verified on their whole texts. No patterns are contained in all texts, and not in any."""
    text = F.lower(F.col(body)) if ignore_case else F.col(body)
    tests = [text.contains(F.lower(F.lit(p)) if ignore_case else F.lit(p)) for p in patterns]
    both = (lambda x, y: x & y) if match_all else (lambda x, y: x | y)
    verified = reduce(both, tests, F.lit(match_all))
    return candidates(docs, stored, patterns, match_all, key, buckets).filter(verified)
