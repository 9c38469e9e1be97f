"""Document terms and corpus term statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from contentloom.functions.core import computed_once, exploded, let
from contentloom.functions.text import term_counts, word_ngrams, word_string, words
from contentloom.llm.common import hash_filter, in_filter
from contentloom.operators.lookup import BROADCAST_BYTES, least_frequent, lookup
from contentloom.session import cut_lineage, written

#: Terms of a text are sorted, so most of a term is the start of the one before.
SORTED_TERMS = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}
#: Bytes of texts whose terms a task holds at once as Python's strings, and terms that it bounds
#: or looks up at once.
TEXT_BYTES, TERMS_AT_ONCE = 1 << 20, 1 << 18
#: Bits of a filter of terms: per term, and least and most in all (64 MB) as powers of two.
BITS_PER_TERM, FILTER_POWERS = 8, (20, 29)


def doc_terms(docs: DataFrame, text: str, ngrams: Sequence[int] = (1,), key: str = "id") -> DataFrame:
    """(id, n_terms, term, tf): counted inside the row, so no shuffle."""
    listed = _listed(docs, text, ngrams, key)
    return exploded(listed, [key, "n_terms"], F.col("_t"), "_e").select(key, "n_terms", "_e.term", "_e.tf")


def _listed(docs: DataFrame, text: str, ngrams: Sequence[int], key: str) -> DataFrame:
    def terms(s: Column) -> Column:
        return F.concat(*[word_ngrams(s, n) for n in ngrams])

    listed = computed_once(docs.select(key, text), {"_terms": let(word_string(text), terms)})
    return listed.select(key, F.size("_terms").cast("bigint").alias("n_terms"), term_counts(F.col("_terms")).alias("_t"))


def stored_doc_terms(docs: DataFrame, text: str, ngrams: Sequence[int] = (1,), key: str = "id") -> DataFrame:
    """``doc_terms`` from a written table with one row per text, for callers that read the
    terms more than once: texts are split and counted a single time."""
    return _unlisted(written(_listed(docs, text, ngrams, key), "terms"), key)


def _unlisted(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key, "n_terms", F.explode("_t").alias("_t")).select(key, "n_terms", "_t.term", "_t.tf")


def _counted(docs: DataFrame, text: str, ngrams: Sequence[int], key: str) -> DataFrame:
    """The rows of ``_listed``, counted by an Arrow-batched function: for terms of several
    words, sorting them in the row takes a multiple of that."""
    listed = _listed(docs, text, ngrams, key)

    def counted(some: pa.RecordBatch) -> pa.RecordBatch:
        terms, tfs, ends, totals = [], [], [0], []
        for words_of in some.column("_words").to_pylist():
            w = words_of.split(" ") if words_of else []
            grams = [w if n == 1 else list(map(" ".join, zip(*(w[i:] for i in range(n))))) for n in ngrams]
            counts = Counter(grams[0])
            for more in grams[1:]:
                counts.update(more)
            found = sorted(counts)
            terms += found
            tfs += map(counts.__getitem__, found)
            ends.append(len(terms))
            totals.append(None if words_of is None else sum(map(len, grams)))
        listed = pa.StructArray.from_arrays([pa.array(terms, pa.string()), pa.array(tfs, pa.int64())], ["term", "tf"])
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed)
        return pa.RecordBatch.from_arrays([some.column(key), pa.array(totals, pa.int64()), listed], names=[key, "n_terms", "_t"])

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("_words")), 0).to_numpy(zero_copy_only=False)
            yield from map(counted, _parts(batch, sizes, TEXT_BYTES))

    return docs.select(key, word_string(text).alias("_words")).mapInArrow(batched, listed.schema)


def _parts(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` in size; memory that Arrow kept of a part is given
    back before the next."""
    starts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1).tolist(), len(sizes)]
    for a, b in zip(starts, starts[1:]):
        yield batch.slice(a, b - a)
        pa.default_memory_pool().release_unused()


def _lengths(lists: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def contending_terms(
    docs: DataFrame,
    text: str,
    n_docs: int,
    k: int,
    ngrams: Sequence[int] = (1, 2),
    key: str = "id",
    max_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """``stored_doc_terms`` without most terms of a text that cannot be among its ``k`` of the
    largest tf * idf, and a materialised ``term_stats`` that has all the other terms.

    The first of ``ngrams`` is 1. The texts of the words are counted first. A term is in no
    more texts than its rarest word and in one at least, which bounds its score; terms whose
    upper bound is below k lower bounds of their text go. Only the texts of the remaining
    terms are counted, found by a filter of hashes, which some others pass as well, and with
    these counts as bounds most terms go that are left.
    """
    rows = written(_counted(docs, text, ngrams, key), "terms", **SORTED_TERMS)
    single = _unlisted(rows, key).filter(~F.contains("term", F.lit(" ")))
    counts = written(term_stats(single, n_docs).select("term", "df"), "words", **SORTED_TERMS)
    few = _cut(rows, counts, n_docs, k, key, max_bytes, by_word=True)
    hashes = few.select(F.explode("_t.term").alias("term")).select(F.xxhash64("term").alias("h"))
    total = few.agg(F.sum(F.size("_t"))).first()[0] or 0
    power = min(max((BITS_PER_TERM * total).bit_length(), FILTER_POWERS[0]), FILTER_POWERS[1])
    bits = np.frombuffer(hash_filter(hashes, "h", power), np.uint8)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, _lengths(batch.column("term")), TERMS_AT_ONCE):
                term, h = part.column("term").flatten(), part.column("h").flatten()
                yield pa.RecordBatch.from_arrays([term.filter(pa.array(in_filter(bits, h.to_numpy())))], names=["term"])

    hashed = rows.select(F.col("_t.term").alias("term"), F.transform("_t.term", lambda t: F.xxhash64(t)).alias("h"))
    stats = cut_lineage(term_stats(hashed.mapInArrow(wanted, "term string"), n_docs))
    return _unlisted(_cut(few, stats, n_docs, k, key, max_bytes), key), stats


def _cut(
    rows: DataFrame, counts: DataFrame, n_docs: int, k: int, key: str, max_bytes: int, by_word: bool = False
) -> DataFrame:
    """Rows of ``_listed`` without the terms that ``counts`` (term, df) of all terms, or of all
    words, rule out. The most frequent, as many as ``max_bytes`` holds, are sent to every task;
    the others are in fewer texts than these."""
    least = least_frequent(counts, "df", max_bytes)
    frequent = counts.filter(F.lit(False) if least is None else F.col("df") >= least).select("term", "df").toArrow()
    known = frequent["term"].combine_chunks()
    # The last place is that of terms that are not known.
    most = (counts.agg(F.max("df")).first()[0] or 1) if least is None else max(1, least - 1)
    texts = np.append(frequent["df"].to_numpy(), most)

    def idf(df: np.ndarray | float) -> np.ndarray:
        return np.log((1.0 + n_docs) / (1.0 + df)) + 1.0

    def bounds(term: pa.Array, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(term, " ") if by_word else None
        found = pc.index_in(split.flatten() if by_word else term, value_set=known)
        place = pc.fill_null(found, len(known)).to_numpy(zero_copy_only=False)
        df, exact = texts[place], place < len(known)
        if by_word and len(term):
            offsets = np.asarray(split.offsets)
            df, exact = np.minimum.reduceat(df, offsets[:-1]), exact[offsets[:-1]] & (np.diff(offsets) == 1)
        return tf * idf(df), tf * np.where(exact, idf(df), idf(1.0))

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        listed = part.column("_t")
        sizes = _lengths(listed)
        term, tf = listed.flatten().flatten()
        stay = _contending(np.repeat(np.arange(len(sizes)), sizes), *bounds(term, tf.to_numpy()), k)
        ends = np.append(0, np.cumsum(stay))[np.append(0, np.cumsum(sizes))]
        mask = pa.array(stay)
        few = pa.StructArray.from_arrays([term.filter(mask), tf.filter(mask)], ["term", "tf"])
        few = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), few)
        return pa.RecordBatch.from_arrays([part.column(key), part.column("n_terms"), few], names=part.schema.names)

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(cut, _parts(batch, _lengths(batch.column("_t")), TERMS_AT_ONCE))

    slim = rows.select(key, "n_terms", "_t")
    return written(slim.mapInArrow(batched, slim.schema), "contenders", **SORTED_TERMS)


def _contending(text: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """Whose upper bound reaches the k-th largest lower bound of its text; with some slack, as
    scores are rounded to six decimals."""
    if not len(text):
        return np.empty(0, bool)
    order = np.lexsort((-low, text))
    starts = np.searchsorted(text, np.arange(text[-1] + 1))
    sizes = np.diff(np.append(starts, len(text)))
    last = np.where(sizes >= k, starts + k - 1, 0)
    least = np.where(sizes >= k, low[order[last]], -np.inf)
    return high * (1 + 1e-12) + 1e-5 >= least[text]


def term_stats(terms: DataFrame, n_docs: int) -> DataFrame:
    """(term, df, idf); one partial count per task and term reaches the shuffle."""
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    return df.withColumn("idf", idf)


def with_idf(
    terms: DataFrame,
    stats: DataFrame,
    key: str = "id",
    max_bytes: int = BROADCAST_BYTES,
    stored: bool = True,
    materialized: bool = False,
) -> DataFrame:
    """Attach df and idf; the vocabulary grows with the corpus, so that of terms from a table
    (``stored``) only the frequent are looked up in every task, of others the hot are salted."""
    return lookup(
        terms, stats, "term", spread_by=key, weight="df", max_bytes=max_bytes,
        materialized=materialized, frequent_first=stored,
    )


def sentences(text: Column | str) -> Column:
    """Sentences in order, trimmed, without empty ones."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.regexp_extract_all(text, F.lit(r"[^.!?\n]+[.!?]*"), F.lit(0))
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != F.lit(""))


def stored_sentence_terms(docs: DataFrame, text: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(id, pos, term, tf) with the sentence number, and (id, term) once per text, both from
    one written table with a row per text."""
    def counted(s: Column, i: Column) -> Column:
        return F.transform(
            term_counts(words(s)),
            lambda t: F.struct(i.alias("pos"), t["term"].alias("term"), t["tf"].alias("tf")),
        )

    flat = let(sentences(text), lambda ss: F.flatten(F.transform(ss, counted)))
    rows = written(docs.select(key, flat.alias("_t")), "sentence_terms")
    per_sentence = rows.select(key, F.inline("_t"))
    return per_sentence, rows.select(key, F.explode(F.array_distinct(F.col("_t.term"))).alias("term"))
