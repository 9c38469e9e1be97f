"""Keyword postings over lower-cased text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contentloom.functions.text import general_tokens
from contentloom.session import cut_lineage

POSTINGS_PER_BLOCK = 4096


def postings(docs: DataFrame, body: str = "body", key: str = "id") -> DataFrame:
    """(term, id): one row per distinct term of a text. Long form, because the list of a
    common term would be a third of the corpus in one cell. Nothing is shuffled."""
    terms = F.array_distinct(general_tokens(F.lower(F.col(body))))
    return docs.select(F.explode(terms).alias("term"), key)


def posting_blocks(posts: DataFrame, key: str = "id", block: int = POSTINGS_PER_BLOCK) -> DataFrame:
    """(term, block, ids, n): postings packed by ranges of a numeric id, so that a block
    never holds more than ``block`` ids however common the term is."""
    return (
        posts.groupBy("term", F.floor(F.col(key) / block).cast("bigint").alias("block"))
        .agg(F.sort_array(F.collect_set(key)).alias("ids"))
        .withColumn("n", F.size("ids"))
    )


def document_frequency(posts: DataFrame) -> DataFrame:
    return posts.groupBy("term").agg(F.count("*").alias("n_docs"))


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_postings(posts: DataFrame, path: str, buckets: int = 256, key: str = "id") -> None:
    """Store by term bucket, sorted by term, so that a look-up reads one bucket and skips
    row groups. Ranges over (bucket, term, id) split a common term over several tasks."""
    out = posts.withColumn("term_bucket", _bucket(F.col("term"), buckets))
    (
        out.repartitionByRange("term_bucket", "term", key)
        .sortWithinPartitions("term_bucket", "term", key)
        .write.mode("overwrite")
        .partitionBy("term_bucket")
        .parquet(path)
    )


def stored_ids(stored: DataFrame, term: str, buckets: int = 256, key: str = "id") -> DataFrame:
    """Ids of one term from stored postings. The bucket is a constant expression, so it
    prunes partitions, and the term filter skips row groups of the sorted files."""
    wanted = F.lit(term.lower())
    return stored.filter(
        (F.col("term_bucket") == _bucket(wanted, buckets)) & (F.col("term") == wanted)
    ).select(key)


def find_all(posts: DataFrame, terms: Sequence[str], key: str = "id") -> DataFrame:
    """Ids that hold every one of the terms."""
    wanted = sorted({t.lower() for t in terms})
    return (
        posts.filter(F.col("term").isin(wanted))
        .groupBy(key)
        .agg(F.count("*").alias("n_terms"))
        .filter(F.col("n_terms") == len(wanted))
        .select(key)
    )


def write_posting_blocks(blocks: DataFrame, table: str, buckets: int = 256) -> None:
    """Store ``posting_blocks`` as a table in partitions by term, sorted by term and block."""
    order = ["term_bucket", "term", "block"]
    dealt = blocks.withColumn("term_bucket", _bucket(F.col("term"), buckets))
    sorted_rows = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.write.format("parquet").partitionBy("term_bucket").saveAsTable(table)


def _term_blocks(stored: DataFrame, term: str, buckets: int) -> DataFrame:
    wanted = F.lit(term)
    return stored.filter((F.col("term_bucket") == _bucket(wanted, buckets)) & (F.col("term") == wanted))


def find_all_stored(stored: DataFrame, terms: Sequence[str], buckets: int = 256, key: str = "id") -> DataFrame:
    """Ids that hold every one of the terms, from stored blocks.

    Only the terms' partitions are read. Sizes and numbers of the blocks come first, without
    the ids: they order the terms, the rarest first, and leave the blocks that all terms
    have. Then the ids of these blocks are opened and intersected block by block, so that
    what comes later is matched against what is left. No terms give no ids.
    """
    wanted = sorted({t.lower() for t in terms})
    none = stored.select(F.explode("ids").alias(key)).limit(0)
    if not wanted:
        return none
    heads = {t: _term_blocks(stored, t, buckets).select("block", "n") for t in wanted}
    sizes = {t: h.agg(F.sum("n")).first()[0] or 0 for t, h in heads.items()}
    if not all(sizes.values()):
        return none
    rarest_first = sorted(wanted, key=lambda t: (sizes[t], t))
    shared = heads[rarest_first[0]].select("block")
    for term in rarest_first[1:]:
        shared = shared.join(heads[term], "block", "left_semi")
    shared = cut_lineage(shared)
    low, high = shared.agg(F.min("block"), F.max("block")).first()
    if low is None:
        return none
    found = None
    for term in rarest_first:
        # The range skips row groups of the sorted files, the semi join the rest.
        blocks = _term_blocks(stored, term, buckets).filter(F.col("block").between(low, high))
        ids = blocks.join(shared, "block", "left_semi").select("block", F.col("ids").alias("_next"))
        if found is None:
            found = ids.withColumnRenamed("_next", "_ids")
        else:
            both = found.join(ids, "block").select("block", F.array_intersect("_ids", "_next").alias("_ids"))
            found = both.filter(F.size("_ids") > 0)
    return found.select(F.explode("_ids").alias(key))
