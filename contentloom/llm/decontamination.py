"""Benchmark decontamination with a distributed positional inverted index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F, types as T

from contentloom.llm.common import hash_filter, in_filter, joined_digest, materialize, slim
from contentloom.operators.lookup import fits_broadcast

WINDOW = 10
#: Words of a window that must be at their places for a proximity match.
NEAR_WORDS = 8
#: Words of benchmark texts that are searched at a time.
PORTION_WORDS = 1 << 20
#: Words of documents and candidate places that a task compares at a time, and distinct words
#: that it remembers.
CHUNK_WORDS, CANDIDATES, MEMO = 1 << 18, 1 << 20, 1 << 18

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_SPACED = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def words_of(text: str | None) -> list[bytes]:
    """Words of digits, a-z and all characters beyond ASCII, A-Z lower-cased before."""
    return (text or "").encode().lower().translate(_SPACED).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A signed 64-bit hash of every word, never 0."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    hashes[hashes == 0] = 1
    return hashes.view(np.int64)


def benchmark_texts(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct texts as hashes of their words (tid, hashes) and the ids that have them (tid,
    item).

    Items of the same words are searched once, however many there are. Items without words
    have no windows and are left out.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [word_hashes(words_of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hashes, pa.list_(pa.int64()))], names=["item", "hashes"]
            )

    source = slim(benchmark, item=id_col, text=text_col).select(F.col("item").cast("string"), "text")
    items = materialize(
        source.mapInArrow(split, "item string, hashes array<long>").filter(F.size("hashes") > 0),
        "benchmark",
    )
    texts = materialize(
        items.select("hashes").distinct().withColumn("tid", F.monotonically_increasing_id()),
        "benchmark_texts",
    )
    return texts, texts.join(items, "hashes").select("tid", "item")


def build_index(docs: DataFrame, text_col: str, keep: list[str], wanted: bytes) -> DataFrame:
    """Token postings, one row per document: ``_row``, n_words, ``terms`` (hashes of its
    distinct words that the filter may hold), ``counts``, ``places`` (each term's positions,
    in the order of the terms) and the columns to keep."""
    source = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(f"`{text_col}`").alias("_text"),
        *[F.col(f"`{c}`").alias(f"_keep_{c}") for c in keep],
    )
    kept = [f for f in source.schema if f.name != "_text"]
    lists = {"terms": (T.LongType(), pa.int64()), "counts": (T.IntegerType(), pa.int32()), "places": (T.IntegerType(), pa.int32())}
    schema = T.StructType(
        [*kept, T.StructField("n_words", T.LongType()), *[T.StructField(n, T.ArrayType(t)) for n, (t, _) in lists.items()]]
    )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = np.frombuffer(wanted, np.uint8), {}
        for batch in batches:
            sizes, postings = [], {name: ([0], []) for name in lists}
            for text in batch.column("_text"):
                words = words_of(text.as_py())
                new = list({w for w in words if w not in known})
                if new:
                    if len(known) > MEMO:
                        known, new = {}, list(set(words))
                    hashes = word_hashes(new)
                    hashes[~in_filter(bits, hashes)] = 0
                    known.update(zip(new, hashes.tolist(), strict=True))
                codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                places = np.flatnonzero(codes)
                places = places[np.argsort(codes[places], kind="stable")]
                terms, counts = np.unique(codes[places], return_counts=True)
                sizes.append(len(words))
                for name, values in (("terms", terms), ("counts", counts), ("places", places)):
                    ends, parts = postings[name]
                    ends.append(ends[-1] + len(values))
                    parts.append(values)
            columns = []
            for name, (_, kind) in lists.items():
                ends, parts = postings[name]
                values = pa.array(np.concatenate([np.empty(0, np.int64), *parts]), kind)
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(sizes, pa.int64()), *columns], names=schema.names
            )

    return materialize(source.mapInArrow(index, schema), "postings")


def term_frequencies(index: DataFrame) -> DataFrame:
    """term, n: how often the corpus has each term."""
    return index.select(F.inline(F.arrays_zip("terms", "counts"))).groupBy(F.col("terms").alias("term")).agg(
        F.sum("counts").alias("n")
    )


def plan_windows(texts: list[tuple[int, np.ndarray]], frequency: dict[int, int], window: int, near: int) -> dict:
    """The distinct windows of a portion of texts and where each is entered.

    ``vocabulary``: sorted word hashes, a word's code is its place from 1; per window its
    ``codes``, ``width``, ``misses`` (words that may differ), ``order`` (offsets, rarest word of
    the corpus first) and texts. At most ``misses`` words of a match differ, so one of the
    ``misses`` + 1 rarest is at its place: these are the window's probes, listed by term.
    """
    vocabulary = np.unique(np.concatenate([h for _, h in texts]))
    counts = np.array([0, *(frequency.get(t, 0) for t in vocabulary.tolist())])
    rows, owners = [], []
    for tid, hashes in texts:
        codes = (np.searchsorted(vocabulary, hashes) + 1).astype(np.int32)
        width = min(window, len(codes))
        found = np.zeros((len(codes) - width + 1, window), np.int32)
        found[:, :width] = sliding_window_view(codes, width)
        rows.append(found)
        owners += [tid] * len(found)
    codes, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.ravel(), np.array(owners, np.int64)], axis=1), axis=0)
    width = (codes > 0).sum(axis=1)
    misses = width - np.minimum(near, width)
    rarity = np.where(codes > 0, counts[codes], np.iinfo(np.int64).max)
    order = np.argsort(rarity, axis=1, kind="stable").astype(np.int8)
    w, rank = np.nonzero(np.arange(window) <= misses[:, None])
    offset = order[w, rank]
    term = codes[w, offset]
    by_term = np.argsort(term, kind="stable")
    return {
        "vocabulary": vocabulary,
        "codes": codes,
        "width": width.astype(np.int8),
        "misses": misses.astype(np.int8),
        "order": order,
        "probes": (np.searchsorted(term[by_term], np.arange(len(vocabulary) + 2)), w[by_term].astype(np.int32), offset[by_term]),
        "texts": (np.searchsorted(pairs[:, 0], np.arange(len(codes) + 1)), pairs[:, 1]),
    }


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def window_matches(words: np.ndarray, plan: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """window, start, probed place and number of differing words of every place where a window
    stands, but for the words that may differ.

    The places of a window's probe, less its offset, are the places to look at; the words
    with the next higher frequency are intersected one after the other.
    """
    first, of_window, of_offset = plan["probes"]
    places = np.flatnonzero(words)
    times = first[words[places] + 1] - first[words[places]]
    places, times = places[times > 0], times[times > 0]
    step = np.searchsorted(np.cumsum(times), np.arange(CANDIDATES, times.sum() + CANDIDATES, CANDIDATES), "left") + 1
    found = []
    for low, high in zip(np.r_[0, step[:-1]], step, strict=True) if len(places) else []:
        at, n = places[low:high], times[low:high]
        probe = _spread(first[words[at]], n)
        w, place = of_window[probe], np.repeat(at, n)
        start = place - of_offset[probe]
        missed = np.zeros(len(w), np.int8)
        for rank in range(plan["codes"].shape[1]):
            offset = plan["order"][w, rank]
            wanted = plan["codes"][w, offset]
            missed += (wanted > 0) & (words[start + offset] != wanted)
            still = missed <= plan["misses"][w]
            if not still.all():
                w, start, place, missed = w[still], start[still], place[still], missed[still]
        found.append((w, start, place, missed))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _chunks(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive documents of a bounded number of words together, longer ones alone."""
    low, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > low and total + n > CHUNK_WORDS:
            yield slice(low, i)
            low, total = i, 0
        total += n
    if low < len(sizes):
        yield slice(low, len(sizes))


def _ints(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and values of a list column."""
    lists = batch.column(name)
    return np.diff(np.asarray(lists.offsets)), np.asarray(lists.flatten())


def _match_batch(batch: pa.RecordBatch, plan: dict) -> Iterator[tuple[int, np.ndarray, list[int], list[int]]]:
    """Row, hit places, texts with a whole window, texts with a near one, of documents with any."""
    window, vocabulary = plan["codes"].shape[1], plan["vocabulary"]
    rows, sizes = batch.column("_row").to_numpy(), batch.column("n_words").to_numpy()
    n_terms, terms = _ints(batch, "terms")
    counts, (n_places, places) = _ints(batch, "counts")[1], _ints(batch, "places")
    code = np.searchsorted(vocabulary, terms).clip(max=len(vocabulary) - 1)
    code = np.where(vocabulary[code] == terms, code + 1, 0).astype(np.int32)
    code = np.repeat(code, counts)
    ends = np.r_[0, np.cumsum(n_places)]
    for part in _chunks(sizes):
        n = sizes[part]
        base = window + np.r_[0, np.cumsum(n[:-1] + window)]
        words = np.zeros(base[-1] + n[-1] + window, np.int32)  # documents apart by empty places
        mine = slice(ends[part.start], ends[part.stop])
        words[np.repeat(base, n_places[part]) + places[mine]] = code[mine]
        w, start, place, missed = window_matches(words, plan)
        doc = np.searchsorted(base, place, "right") - 1
        inside = (start >= base[doc]) & (start + plan["width"][w] <= base[doc] + n[doc])
        w, start, doc, missed = w[inside], start[inside], doc[inside], missed[inside]
        whole = missed == 0
        hit = np.zeros(len(words), bool)
        hit[_spread(start[whole], plan["width"][w[whole]].astype(np.int64))] = True
        first, owners = plan["texts"]
        pairs = np.unique(np.stack([doc, w, ~whole], axis=1), axis=0)
        times = first[pairs[:, 1] + 1] - first[pairs[:, 1]]
        text = owners[_spread(first[pairs[:, 1]], times)]
        pairs = np.unique(np.stack([np.repeat(pairs[:, 0], times), np.repeat(pairs[:, 2], times), text], axis=1), axis=0)
        for d in np.unique(pairs[:, 0]).tolist():
            low, mid, high = np.searchsorted(pairs[:, 0] * 2 + pairs[:, 1], [2 * d, 2 * d + 1, 2 * d + 2])
            hits = np.flatnonzero(hit[base[d] : base[d] + n[d]])
            yield int(rows[part][d]), hits, pairs[low:mid, 2], pairs[mid:high, 2]


def find_matches(index: DataFrame, plan: dict) -> DataFrame:
    """_row, hits (places), phrases (tids), nears (tids) of documents with a match."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_match_batch(batch, plan)) if batch.num_rows else []
            rows, *lists = zip(*found, strict=True) if found else ([], [], [], [])
            kinds = (pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), *[pa.array([x.tolist() for x in v], pa.list_(k)) for v, k in zip(lists, kinds, strict=True)]],
                names=["_row", "hits", "phrases", "nears"],
            )

    columns = index.filter(F.size("terms") > 0).select("_row", "n_words", "terms", "counts", "places")
    schema = "_row long, hits array<int>, phrases array<long>, nears array<long>"
    return materialize(columns.mapInArrow(match, schema), "matches")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    *,
    keep: list[str] | None = None,
    window: int = WINDOW,
    near_words: int = NEAR_WORDS,
    portion_words: int = PORTION_WORDS,
) -> DataFrame:
    """Which words of a document lie in a window of a benchmark item, and of which items.

    One row per input row: the id (and the columns of ``keep``), n_words, n_hit, n_items,
    items_sha256, contaminated, n_near. A window is ``window`` consecutive words of an
    item; a shorter item is one window. NULL and wordless texts have no words and no hits;
    wordless items match nothing; repeated documents are judged each; a benchmark id that is
    NULL is not listed; empty tables give no rows, or no hits; other columns are ignored.
    n_near counts all different item texts of which only ``near_words`` words or more of a
    window stand at their places; a window that is shorter than that must be whole.

    The corpus is indexed once: the positions of every benchmark word, by document. Benchmark
    texts are searched in portions of bounded size, each against the whole index, which
    stays where it is; only matches are shuffled.
    """
    names = list(dict.fromkeys([id_col, *(keep or [])]))
    texts, items = benchmark_texts(benchmark, item_id_col, item_text_col)
    terms = texts.select(F.explode("hashes").alias("term")).distinct()
    index = build_index(docs, text_col, names, hash_filter(terms, "term"))
    frequencies = materialize(term_frequencies(index), "frequencies")
    portions = -(-(texts.agg(F.sum(F.size("hashes"))).first()[0] or 0) // portion_words)
    texts = texts.withColumn("portion", F.pmod(F.xxhash64("tid"), F.lit(max(portions, 1))))
    found = []
    for portion in range(portions):
        mine = texts.filter(F.col("portion") == portion)
        rows = [(r["tid"], np.array(r["hashes"], np.int64)) for r in mine.collect()]
        if rows:
            used = mine.select(F.explode("hashes").alias("term")).distinct().join(frequencies, "term")
            frequency = {r["term"]: r["n"] for r in used.collect()}
            found.append(find_matches(index, plan_windows(rows, frequency, window, near_words)))
    if not found:
        schema = "_row long, hits array<int>, phrases array<long>, nears array<long>"
        found = [docs.sparkSession.createDataFrame([], schema)]
    matches = found[0]
    for more in found[1:]:
        matches = matches.union(more)
    both = lambda c: F.array_distinct(F.flatten(F.collect_list(c))).alias(c)
    matches = materialize(matches.groupBy("_row").agg(both("hits"), both("phrases"), both("nears")), "matches")
    listed = (
        matches.select("_row", F.explode("phrases").alias("tid"))
        .join(items, "tid")
        .filter("item IS NOT NULL")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    per_row = matches.select(
        "_row",
        F.size("hits").cast("long").alias("n_hit"),
        F.size(F.array_except("nears", "phrases")).cast("long").alias("n_near"),
    ).join(listed, "_row", "left")
    none = F.array().cast("array<string>")
    items_found = F.coalesce(F.col("items"), none)
    hit = F.coalesce(F.col("n_hit"), F.lit(0))
    return index.join(per_row, "_row", "left").select(
        *[F.col(f"_keep_{c}").alias(c) for c in names],
        "n_words",
        hit.alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        joined_digest(items_found).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.coalesce(F.col("n_near"), F.lit(0)).cast("long").alias("n_near"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input without the documents that hold a window of a benchmark item.

    Texts are read twice and stay in their tasks: hits come back as ids and hashes of texts.
    Rows of one id and different texts are judged each.
    """
    key = F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("t"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), key.alias("key"))
    texts = marked.select("key", F.col("_doc").getField(text_col).alias("text"))
    judged = decontaminate(texts, benchmark, "key", "text", **options)
    hits = materialize(judged.filter("contaminated").select("key").distinct(), "hits")
    return marked.join(F.broadcast(hits) if fits_broadcast(hits) else hits, "key", "left_anti").select("_doc.*")
