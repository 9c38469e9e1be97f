"""Exact ranked lexical search over an index that is stratified by document length."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from contentloom.llm.common import hash_filter, in_filter, materialize, require_whole_numbers, slim
from contentloom.operators.lookup import lookup

# Fixed values of the score: gain and saturation of a term, weight of the length in percent.
SCALE, TF_SCALE, LENGTH_SCALE, PERCENT = 1_000_000_000, 1000, 12, 25
K = 20
#: Documents of a block, which is a stratum or a part of one, and of a task's bin of blocks.
BLOCK_DOCS, BIN_DOCS = 1024, 8192
#: Items and terms of the queries that are searched at a time.
QUERY_ITEMS, QUERY_TERMS = 256, 25_000
#: Bins whose best stratum gives every item its first threshold.
SEED_BINS = 64
#: Distinct words that a task remembers at a time.
MEMO = 1 << 18

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_SPACED = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))
_DOCS = "m long, part long, bin long, term long, tfs array<int>, ends array<int>, docs array<long>"


def terms_of(text: str | None) -> list[bytes]:
    """Terms of digits, letters and all characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode().translate(_SPACED).lower().split()


def term_hash(term: bytes) -> int:
    """A signed 64-bit hash, which stands for the term in the index."""
    h = xxhash.xxh3_64_intdigest(term)
    return h - (1 << 64) if h >> 63 else h


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """q (one per row), item, term, times: the distinct terms of every item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, text in zip(batch.column(0), batch.column(2), strict=True):
                found = Counter(map(term_hash, terms_of(text.as_py())))
                row = batch.slice(0, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([q.as_py()] * len(found), row.column(0).type),
                        pa.array(list(found), pa.int64()),
                        pa.array(list(found.values()), pa.int64()),
                    ],
                    names=["q", "term", "times"],
                )

    source = slim(items, item=id_col, text=text_col).withColumn("q", F.monotonically_increasing_id())
    source = materialize(source.select("q", "item", "text"), "items")
    found = source.mapInArrow(split, "q long, term long, times long")
    return materialize(found.join(source.select("q", "item"), "q"), "query_terms")


def term_counts(docs: DataFrame, id_col: str, text_col: str, wanted: bytes | None) -> DataFrame:
    """row, doc, n (terms with repeats) and the distinct ``terms`` with their ``tfs``, one row
    per document; only terms that the filter ``wanted`` may hold, if there is one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if wanted is None else np.frombuffer(wanted, np.uint8)
        known: dict[bytes, int | None] = {}
        for batch in batches:
            sizes, ends, terms, tfs = [], [0], [], []
            for text in batch.column(2):
                words = terms_of(text.as_py())
                counts = Counter(words)
                new = [w for w in counts if w not in known]
                if new:
                    if len(known) > MEMO:
                        known, new = {}, list(counts)
                    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new)).view(np.int64)
                    kept = np.ones(len(new), bool) if bits is None else in_filter(bits, hashes)
                    known.update(zip(new, [h if k else None for h, k in zip(hashes.tolist(), kept, strict=True)], strict=True))
                for word, tf in counts.items():
                    h = known[word]
                    if h is not None:
                        terms.append(h)
                        tfs.append(tf)
                sizes.append(len(words))
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int64())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
                ],
                names=["row", "doc", "n", "terms", "tfs"],
            )

    source = slim(docs, doc=id_col, text=text_col).select(
        F.monotonically_increasing_id().alias("row"), F.col("doc").cast("long"), "text"
    )
    found = source.mapInArrow(count, "row long, doc long, n long, terms array<long>, tfs array<int>")
    return materialize(found.filter("n > 0"), "term_counts")


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Offsets and values of a list column."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], column.type)
    offsets = np.asarray(lists.offsets)
    return offsets - offsets[0], np.diff(offsets), lists.flatten()


def _invert(table: pa.Table) -> pa.Table:
    """Postings of the documents of one bin: a row per block and term, whose documents are
    grouped by tf, highest first, and a row per block with its documents' ids."""
    m, part, ids = (table[c].to_numpy() for c in ("m", "part", "_doc_rank"))
    order = np.lexsort((ids, part, m))
    table, m, part = table.take(order), m[order], part[order]
    bin_id = table["bin"][0].as_py()
    _, sizes, terms = _lists(table["terms"])
    terms, tfs = np.asarray(terms), np.asarray(_lists(table["tfs"])[2])
    new_block = np.r_[True, (m[1:] != m[:-1]) | (part[1:] != part[:-1])]
    first = np.flatnonzero(new_block)
    block = np.cumsum(new_block) - 1
    slot = np.arange(len(m)) - first[block]
    owner = np.repeat(np.arange(len(m)), sizes)
    at = np.lexsort((slot[owner], -tfs, terms, block[owner]))
    owner, terms, tfs = owner[at], terms[at], tfs[at]
    of = block[owner]
    new_term = np.r_[True, (of[1:] != of[:-1]) | (terms[1:] != terms[:-1])] if len(of) else np.empty(0, bool)
    new_run = np.r_[True, new_term[1:] | (tfs[1:] != tfs[:-1])] if len(of) else np.empty(0, bool)
    row_at, run_at = np.flatnonzero(new_term), np.flatnonzero(new_run)
    runs_of = np.searchsorted(run_at, np.r_[row_at, len(of)]).astype(np.int32)
    run_end = np.r_[run_at[1:], len(of)].astype(np.int64)
    run_end = run_end - np.repeat(row_at, np.diff(runs_of))
    kinds = [("docs", pa.int64()), ("tfs", pa.int32()), ("ends", pa.int32())]
    lists = {
        "docs": pa.ListArray.from_arrays(pa.array(np.r_[row_at, len(of)].astype(np.int32)), pa.array(slot[owner], pa.int64())),
        "tfs": pa.ListArray.from_arrays(pa.array(runs_of), pa.array(tfs[run_at], pa.int32())),
        "ends": pa.ListArray.from_arrays(pa.array(runs_of), pa.array(run_end, pa.int32())),
    }
    heads = {
        "docs": pa.ListArray.from_arrays(pa.array(np.r_[first, len(m)].astype(np.int32)), table["doc"].combine_chunks()),
        "tfs": pa.array([[]] * len(first), pa.list_(pa.int32())),
        "ends": pa.array([[]] * len(first), pa.list_(pa.int32())),
    }
    shown = np.r_[of[row_at], np.arange(len(first))]
    return pa.table(
        {
            "m": pa.array(m[first][shown], pa.int64()),
            "part": pa.array(part[first][shown], pa.int64()),
            "bin": pa.array(np.full(len(shown), bin_id), pa.int64()),
            "term": pa.concat_arrays([pa.array(terms[row_at], pa.int64()), pa.nulls(len(first), pa.int64())]),
            **{name: pa.concat_arrays([lists[name], heads[name].cast(pa.list_(kind))]) for name, kind in kinds},
        }
    ).select(["m", "part", "bin", "term", "tfs", "ends", "docs"])


def build_index(
    docs: DataFrame, id_col: str, text_col: str, wanted: bytes | None = None
) -> tuple[DataFrame, int, int]:
    """The written index, the number of documents with terms, the number of bins.

    A stratum is all documents of one normaliser m. Large strata are dealt to blocks of
    bounded size, blocks to bins, which the table is bucketed by. Rows: m, part, bin, term
    and its postings ``docs`` (places in the block), ordered by tf; ``tfs`` are the distinct
    tf, highest first, ``ends`` where each ends in ``docs``. The row without a term lists
    the block's ids in ascending order.
    """
    counts = term_counts(docs, id_col, text_col, wanted)
    total = counts.agg(F.count("*"), F.sum("n")).first()
    n_docs, length = total[0], total[1] or 1
    m = F.expr(f"{100 - PERCENT} + ({PERCENT} * n * {n_docs}L) div {length}L")
    counts = counts.withColumn("m", m)
    strata = counts.groupBy("m").agg(F.count("*").alias("size"))
    bins = max(1, -(-n_docs // BIN_DOCS))
    dealt = (
        lookup(counts, strata, "m", "row", weight="size")
        .withColumn("part", F.pmod(F.xxhash64("row"), F.ceil(F.col("size") / BLOCK_DOCS)))
        .withColumn("bin", F.pmod(F.xxhash64("m", "part"), F.lit(bins)))
        .withColumn("_doc_rank", F.coalesce("doc", F.lit((1 << 63) - 1)))
        .filter(F.size("terms") > 0)
        .select("bin", "m", "part", "doc", "_doc_rank", "terms", "tfs")
    )
    index = dealt.groupBy("bin").applyInArrow(_invert, _DOCS)
    return materialize(index, "postings", bucket_by="bin"), n_docs, bins


def _search_bin(table: pa.Table, queries: dict, seed: bool, step: int) -> pd.DataFrame:
    """The best documents of one bin for every item of a block of queries.

    A stratum's bound for an item takes the impact of each term's highest tf there. As
    ``seed``, an item visits the stratum of its greatest bound; else it visits the others,
    in order of their bounds, which can still reach its threshold.
    """
    vocabulary, weights, theta, k = (queries[x] for x in ("vocabulary", "weights", "theta", "k"))
    none = pd.DataFrame({"q": [], "doc": [], "score": []})
    m, part = table["m"].to_numpy(), table["part"].to_numpy()
    is_head = pc.is_null(table["term"]).to_numpy()
    terms = pc.fill_null(table["term"], 0).to_numpy()
    column = np.searchsorted(vocabulary, terms).clip(max=len(vocabulary) - 1)
    asked = ~is_head & (vocabulary[column] == terms)
    order = np.lexsort((column, part, m))
    order = order[asked[order] | is_head[order]]
    start, size, docs = _lists(table["docs"])
    ids = docs
    docs = np.asarray(pc.fill_null(docs, 0))
    run_start, run_size, tfs = _lists(table["tfs"])
    tfs, ends = np.asarray(tfs).astype(np.int64), np.asarray(_lists(table["ends"])[2])
    per_run = np.repeat(m, run_size)
    impact = SCALE * tfs // (TF_SCALE * tfs + LENGTH_SCALE * per_run)  # once per tf of a posting
    edges = np.flatnonzero(np.r_[True, (m[order][1:] != m[order][:-1]) | (part[order][1:] != part[order][:-1])])
    blocks = []
    for low, high in zip(edges, np.r_[edges[1:], len(order)], strict=True):
        rows = order[low:high]
        head, rows = rows[is_head[rows]], rows[~is_head[rows]]
        if len(rows) and len(head):
            peak = impact[run_start[rows]].astype(float)
            blocks.append((int(head[0]), rows, weights[:, column[rows]] @ peak))
    if not blocks:
        return none
    bounds = np.stack([b for _, _, b in blocks], axis=1)
    best = bounds.argmax(axis=1)
    items = np.arange(len(weights))
    visit = bounds > 0
    if seed:
        only = np.zeros_like(visit)
        only[items, best] = True
        visit &= only
    else:
        visit &= bounds >= theta[:, None]
        if queries["bin"] % step == 0:
            visit[items, best] = False
    found = []
    for j in np.argsort(-(bounds * visit).max(axis=0), kind="stable"):
        head, rows, bound = blocks[j]
        which = np.flatnonzero(visit[:, j] & (bound >= theta))
        if not len(which):
            continue
        matrix = np.zeros((len(rows), size[head]))
        for i, r in enumerate(rows):
            runs = slice(run_start[r], run_start[r] + run_size[r])
            lengths = np.diff(ends[runs], prepend=0)
            matrix[i, docs[start[r] : start[r] + size[r]]] = np.repeat(impact[runs], lengths)
        scores = weights[np.ix_(which, column[rows])] @ matrix
        floor = np.maximum(theta[which], 1)
        if scores.shape[1] > k:
            floor = np.maximum(floor, np.partition(scores, -k, axis=1)[:, -k])
        at, to = np.nonzero(scores >= floor[:, None])
        got = scores[at, to]
        place = np.lexsort((to, -got, at))
        at, to, got = at[place], to[place], got[place]
        nth = np.arange(len(at)) - np.searchsorted(at, at, side="left")
        at, to, got = at[nth < k], to[nth < k], got[nth < k]
        found.append((which[at], start[head] + to, got))
        full = np.flatnonzero(np.bincount(at, minlength=len(which)) >= k)
        if len(full):  # the k-th best of one stratum is a threshold for the next ones
            last = np.searchsorted(at, full, side="right") - 1
            theta[which[full]] = np.maximum(theta[which[full]], got[last])
    if not found:
        return none
    which, at, score = (np.concatenate(x) for x in zip(*found, strict=True))
    out = pd.DataFrame(
        {
            "q": queries["q"][which],
            "doc": pd.array(ids.take(pa.array(at)).to_pylist(), dtype="Int64"),
            "score": score.astype(np.int64),
        }
    )
    out = out.sort_values(["q", "score", "doc"], ascending=[True, False, True])
    return out.groupby("q", sort=False).head(k)


def _visit(index: DataFrame, queries: dict, seed: bool, step: int) -> DataFrame:
    """Visit the strata of every bin, of each ``step``-th bin only as ``seed``."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        mine = queries | {"theta": queries["theta"].copy(), "bin": key[0].as_py()}
        out = _search_bin(table, mine, seed, step)
        schema = pa.schema([("q", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())])
        return pa.Table.from_pandas(out, schema, preserve_index=False)

    bins = index.filter(F.col("bin") % step == 0) if seed else index
    found = bins.groupBy("bin").applyInArrow(run, "q long, doc long, score long")
    return materialize(found, "seeds" if seed else "found")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    *,
    k: int = K,
) -> DataFrame:
    """The k best documents of every item by the sum of its terms' weighted impacts.

    A term's weight is floor(1000 ln((2N+2)/(2df+1))), its impact in a document
    10^9 tf div (1000 tf + 12 m), where m grows with the document's length. One row per item
    and rank: item_id, rank, doc_id, score; equal scores by ascending id, NULL last; scores
    of 0 are not returned. NULL texts and those without terms count nowhere; repeated rows
    are documents, or items, each; items without a match have no rows; empty tables give
    no rows; other columns are ignored; ids of documents must be whole numbers.

    Only terms that some item has are indexed. Items are searched in blocks of bounded
    size, each over the whole index: first the stratum of the greatest bound in some bins,
    for a score that k documents reach, then every stratum whose bound can reach it.
    """
    require_whole_numbers(docs, id_col)
    asked = query_terms(items, item_id_col, item_text_col)
    index, n_docs, bins = build_index(docs, id_col, text_col, hash_filter(asked, "term"))
    postings = index.filter("term IS NOT NULL")
    df = postings.groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    used = asked.select("term").distinct()
    df = materialize(df.join(used, "term").select("term", weight.alias("w")), "weights")
    size = asked.agg(F.count_distinct("q"), F.count("*")).first()
    parts = max(1, -(-size[0] // QUERY_ITEMS), -(-size[1] // QUERY_TERMS))
    weighted = asked.join(df, "term").select(
        "q", "term", (F.col("w") * F.col("times")).alias("w"), F.pmod(F.xxhash64("q"), F.lit(parts)).alias("portion")
    )
    weighted = materialize(weighted, "weighted")
    step = max(1, bins // SEED_BINS)
    results = []
    for portion in range(parts):
        rows = weighted.filter(F.col("portion") == portion).select("q", "term", "w").toPandas()
        if rows.empty:
            continue
        q, at = np.unique(rows["q"].to_numpy(), return_inverse=True)
        vocabulary, to = np.unique(rows["term"].to_numpy(), return_inverse=True)
        weights = np.zeros((len(q), len(vocabulary)))
        weights[at, to] = rows["w"].to_numpy()
        if weights.sum(axis=1).max() * (SCALE / TF_SCALE) >= 2**53:
            raise OverflowError("scores of an item with so many terms would be rounded")
        queries = {"q": q, "vocabulary": vocabulary, "weights": weights, "theta": np.zeros(len(q)), "k": k}
        seeds = _visit(index, queries, True, step)
        reached = _best(seeds, k).filter(F.col("rank") == k).select("q", "score").collect()
        theta = {r["q"]: r["score"] for r in reached}
        queries["theta"] = np.array([float(theta.get(i, 0)) for i in q.tolist()])
        results.append(_best(seeds.union(_visit(index, queries, False, step)), k))
    if not results:
        results = [docs.sparkSession.createDataFrame([], "q long, doc long, score long, rank int")]
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    named = asked.select("q", F.col("item").alias(item_id_col)).distinct()
    return found.join(named, "q").select(
        item_id_col, F.col("rank").cast("int"), F.col("doc").alias(id_col), "score"
    )
