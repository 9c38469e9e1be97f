"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard checks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window, functions as F

from contentloom.llm.common import materialize, require_whole_numbers, slim
from contentloom.operators.keyed import with_ordinal
from contentloom.operators.lookup import fits_broadcast, lookup

SHINGLE = 5
#: Bands of ROWS coordinates. A pair at Jaccard 0.85 misses all of them once in 10^8 cases,
#: at 0.8 once in 3 * 10^5.
BANDS, ROWS = 42, 6
#: Size of the permuted universe that shingle hashes are folded into.
UNIVERSE_BITS = 22
SEED = 20_240_229
#: Rows of a bucket's block that a task compares with another block, rows of a task's bin
#: on average, columns of a piece of the incidence matrix.
CELL, BIN_ROWS, COLUMNS = 512, 1024, 4096

_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * _MIX[0]
    x = (x ^ (x >> np.uint64(33))) * _MIX[1]
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=4)
def _weights(n: int, salt: int) -> np.ndarray:
    """Odd multipliers, the same in every process."""
    return _mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) | np.uint64(1)


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    A-Z is lower-cased, words end at ASCII white space. A text of fewer words is one
    shingle; without words the set is empty.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    n = min(size, len(words))
    weights = _weights(size, 1)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        total += h[j : len(words) - n + 1 + j] * weights[j]
    return np.unique(_mix(total))


@lru_cache(maxsize=2)
def _circulant(coordinates: int) -> np.ndarray:
    """Row p holds the second permutation's values at p, p+1, ...: what the circularly
    shifted permutations give for a shingle that the first one has sent to p."""
    order = np.random.default_rng(SEED).permutation(1 << UNIVERSE_BITS).astype(np.uint32)
    return sliding_window_view(np.concatenate([order, order[: coordinates - 1]]), coordinates)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """All coordinates from two permutations: the first scatters the shingles, the second is
    shifted by one place per coordinate. The minima are taken over blocks of shingles."""
    shifted = _circulant(coordinates)
    first = _mix(shingles ^ np.uint64(SEED)) & np.uint64((1 << UNIVERSE_BITS) - 1)
    low = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(first), 1024):
        np.minimum(low, shifted[first[i : i + 1024]].min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    values = low.reshape(bands, rows).astype(np.uint64)
    weights = _weights(rows, 2)
    mixed = _mix((values * weights).sum(axis=1, dtype=np.uint64) + _weights(bands, 3))
    return mixed.view(np.int64)


def features(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """One written row per document: id, n (set size), s1 and s2 (fingerprint of the set),
    keys (one per band; none for an empty set), sketch (a byte of every coordinate)."""
    source = slim(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s1, s2, keys, sketch = [], [], [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), shingle)
                low = signature(shingles, bands * rows)
                n.append(len(shingles))
                s1.append(int(_mix(shingles + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(_mix(shingles + np.uint64(2)).sum(dtype=np.uint64).view(np.int64)))
                keys.append(band_keys(low, bands, rows) if n[-1] else [])
                sketch.append(low.astype(np.uint8).tobytes())
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (n, s1, s2))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                names=["id", "n", "s1", "s2", "keys", "sketch"],
            )

    schema = "id long, n long, s1 long, s2 long, keys array<long>, sketch binary"
    return materialize(source.mapInArrow(run, schema), "minhash")


def stored_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """id, shingles (sorted 64-bit values as bytes) of the documents named in ``ids`` (id, s1).

    Only their texts are hashed again. Ids whose measured size allows it go to the texts;
    otherwise both are shuffled by id.
    """
    wanted = materialize(ids.select("id", "s1").distinct(), "wanted")
    if fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    source = slim(docs, id=id_col, text=text_col).join(wanted, "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(1)]
            mark = [int(_mix(s + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(mark, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["id", "s1", "shingles"],
            )

    found = source.mapInArrow(run, "id long, s1 long, shingles binary")
    return materialize(found.join(wanted, ["id", "s1"], "left_semi"), "shingles")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    return materialize(pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """id, label (smallest id reachable) of every id of the links.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so that long chains shorten too. Minima are combined before the shuffle, so a
    node with very many links is no burden.
    """
    both = materialize(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label"))
    labels = materialize(labels, "labels")
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("a"), "label"), "a")
            .groupBy(F.col("b").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        up = labels.select(F.col("id").alias("via"), F.col("label").alias("up"))
        step = (
            labels.join(near, "id")
            .withColumn("via", F.least("label", "near"))
            .join(up, "via")
            .select("id", F.least("via", "up").alias("label"), F.col("label").alias("old"))
        )
        step = materialize(step, "labels")
        labels = step.select("id", "label")
        if step.filter("label != old").isEmpty():
            return labels


def _compatible(n: str, m: str, percent: int):
    """Sets whose sizes allow the similarity at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _in_cells(rows: DataFrame, value: str) -> DataFrame:
    """Rows (key, id, label, n, size and a bytes column) dealt to ``bin``: cells of a bucket
    that every pair of its rows shares one of.

    A bucket of up to CELL rows is one cell. A larger one is cut into blocks, and each pair
    of blocks is a cell, so no task holds a large bucket whole. Cells are put into bins of
    a bounded number of rows on average.
    """
    blocks = F.ceil(F.col("size") / CELL).cast("long")
    zero = F.lit(0).cast("long")
    dealt = (
        rows.withColumn("_block", F.pmod(F.xxhash64("id", "key"), blocks))
        .withColumn("_other", F.explode(F.sequence(zero, blocks - 1)))
        .withColumn("i", F.least("_block", "_other"))
        .withColumn("j", F.greatest("_block", "_other"))
    )
    cells = rows.agg(F.sum(blocks)).first()[0] or 0
    bins = max(1, -(-cells // BIN_ROWS))
    return dealt.select(
        "key", "i", "j", "id", "label", "n", value, F.pmod(F.xxhash64("key", "i", "j"), F.lit(bins)).alias("bin")
    )


def _per_cell(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, cell in rows.groupby(["key", "i", "j"], sort=False):
        if len(cell) > 1:
            yield cell


def _open_pairs(cell: pd.DataFrame, percent: int) -> np.ndarray:
    """Which pairs of a cell are still apart and have sizes that allow a link."""
    label, n = cell["label"].to_numpy(), cell["n"].to_numpy()
    fits = 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
    return np.triu(fits & (label[:, None] != label), 1)


def likely_members(rows: DataFrame, percent: int, coordinates: int) -> DataFrame:
    """The rows that some row of another component resembles by its sketch.

    A sketch has a byte of every coordinate; the share of equal ones is compared with the
    threshold less five standard deviations of the estimate.
    """
    share = percent / 100
    least = coordinates * (share - 5 * (share * (1 - share) / coordinates) ** 0.5)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for cell in _per_cell(rows):
            sketch = np.frombuffer(b"".join(cell["sketch"]), np.uint8).reshape(len(cell), -1)
            left = _open_pairs(cell, percent)
            near = np.zeros(len(cell), bool)
            for x in np.flatnonzero(left.any(axis=1)):
                y = np.flatnonzero(left[x])
                y = y[(sketch[y] == sketch[x]).sum(axis=1) >= least]
                near[y] = True
                near[x] |= len(y) > 0
            out.append(cell.loc[near, ["key", "i", "j", "bin", "id", "label", "n"]])
        return pd.concat(out) if out else rows.head(0)[["key", "i", "j", "bin", "id", "label", "n"]]

    schema = "key long, i long, j long, bin long, id long, label long, n long"
    found = _in_cells(rows, "sketch").groupBy("bin").applyInPandas(run, schema)
    return materialize(found, "likely")


def _common(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs asked for (0 elsewhere)."""
    n = len(sets)
    out = np.zeros((n, n), np.int64)
    asked = np.argwhere(pairs)
    if len(asked) <= 4 * n:
        for x, y in asked:
            out[x, y] = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        return out
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    place = np.full(len(times), -1)
    place[shared] = np.arange(len(shared))
    at = place[column]
    for low in range(0, len(shared), COLUMNS):
        part = (at >= low) & (at < low + COLUMNS)
        has = np.zeros((n, min(COLUMNS, len(shared) - low)), np.float32)
        has[owner[part], at[part] - low] = 1
        out += (has @ has.T).astype(np.int64)
    return out


def linked_members(likely: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that the full sets confirm: one for every two components that a cell
    joins, however many pairs do."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for cell in _per_cell(rows):
            shingles = [np.frombuffer(x, np.uint64) for x in cell["shingles"]]
            left = _open_pairs(cell, percent)
            common, n = _common(shingles, left), cell["n"].to_numpy()
            x, y = np.nonzero(left & (100 * common >= percent * (n[:, None] + n - common)))
            label, ids = cell["label"].to_numpy(), cell["id"].to_numpy()
            both = np.sort(np.stack([label[x], label[y]], axis=1), axis=1)
            first = np.unique(both, axis=0, return_index=True)[1]
            out.append(np.stack([ids[x[first]], ids[y[first]]], axis=1))
        found = np.concatenate(out) if out else np.empty((0, 2), np.int64)
        return pd.DataFrame(found, columns=["a", "b"])

    full = likely.join(sets.select("id", "shingles"), "id")
    return materialize(full.groupBy("bin").applyInPandas(run, "a long, b long"), "links")


def link_representatives(
    docs: DataFrame, found: DataFrame, id_col: str, text_col: str, shingle: int, percent: int
) -> DataFrame:
    """id, label of the representatives that a chain of links joins.

    A pair is a candidate if it shares a bucket (a band's key). First every representative
    is compared with the most central member of its buckets, which joins most copies of a
    text at one comparison each. Buckets whose members are then in one component are done.
    In the others, members of different components are compared by sketch and, where those
    are alike, by their full sets, inside tasks that hold a bounded part of a bucket. Pairs
    of one component need no comparison, and no pairs are written but links.
    """
    groups = found.filter("n > 0 AND id IS NOT NULL").groupBy("n", "s1", "s2").agg(F.min("id").alias("id"))
    reps = found.join(groups, ["id", "n", "s1", "s2"], "left_semi")
    keyed = reps.select("id", "n", "s1", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = materialize(keyed.join(buckets, "key"), "buckets")
    if shared.isEmpty():
        return docs.sparkSession.createDataFrame([], "id long, label long")
    central = shared.groupBy("id").agg(F.sum("size").alias("score"))
    shared = materialize(shared.join(central, "id"), "buckets")
    sets = stored_sets(docs, shared.select("id", "s1"), id_col, text_col, shingle)

    best = F.max(F.struct("score", (-F.col("id")).alias("low"), "id", "n"))
    pivot = shared.groupBy("key").agg(best.alias("p")).select(
        "key", F.col("p.id").alias("pivot"), F.col("p.n").alias("m"), F.col("p.score").alias("rank")
    )
    fits = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    star = shared.join(pivot, "key").filter(fits & (F.col("id") != F.col("pivot")))
    first = star.groupBy("id").agg(F.max(F.struct("rank", (-F.col("pivot")).alias("low"))).alias("p"))
    pairs = first.select("id", (-F.col("p.low")).alias("pivot"))
    pairs = pairs.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    links = verified(pairs, sets, percent)

    marked = shared.join(components(links), "id", "left").withColumn("label", F.coalesce("label", "id"))
    marked = materialize(marked.select("key", "id", "n", "label"), "marked")
    open_buckets = marked.groupBy("key").agg(
        F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("size")
    ).filter("l != h")
    apart = marked.join(open_buckets.select("key", "size"), "key").join(
        reps.select("id", "sketch").distinct(), "id"
    )
    likely = likely_members(materialize(apart, "apart"), percent, len(found.first()["sketch"]))
    return components(links.union(linked_members(likely, sets, percent)))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    percent: int = 80,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Groups of near-duplicates: a chain of links, each of Jaccard ``percent`` or more.

    One row per input row: the id (a whole number, others are refused), n_shingles, component_id (smallest id of the
    group), kept. Texts of one shingle set form a group through their fingerprints and are
    compared through their smallest id only. Empty texts are linked with nothing; a row
    without id is linked with nothing, has no component_id and is kept; repeated rows get
    the same answer each; an empty table gives no rows; other columns are ignored.
    """
    require_whole_numbers(docs, id_col)
    found = features(docs, id_col, text_col, shingle, bands, rows)
    labels = link_representatives(docs, found, id_col, text_col, shingle, percent)
    group = F.struct("n", "s1", "s2").alias("g")
    copies = (
        found.filter("n > 0 AND id IS NOT NULL")
        .groupBy("n", "s1", "s2")
        .agg(F.min("id").alias("rep"), F.count("*").alias("size"))
        .filter("size > 1")
        .join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        .select(group, F.coalesce("label", "rep").alias("of_copies"), "size")
    )
    # A group of very many copies is looked up in salted parts.
    rows = lookup(
        found.select("id", "n", group), materialize(copies, "copies"), "g", "id", "left", weight="size", materialized=True
    )
    label = F.when(F.col("id").isNotNull(), F.coalesce("of_copies", "label", "id"))
    return rows.join(labels, "id", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        label.alias("component_id"),
        F.coalesce(F.col("id") == label, F.lit(True)).alias("kept"),
    )


def _own_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_doc (the row), text, t (its hash), own: the id, or a new one above all others for each
    different text of an id that several texts share; NULL without an id."""
    text = F.col(f"`{text_col}`")
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        text.alias("text"),
        F.struct(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("t")).alias("key"),
    )
    several = marked.groupBy("key.id").agg(F.min("key.t").alias("a"), F.max("key.t").alias("b"))
    several = several.filter("a != b AND id IS NOT NULL").select("id")
    pairs = marked.select("key", "key.id").join(several, "id", "left_semi").select("key").distinct()
    top = marked.agg(F.max("key.id")).first()[0] or 0
    renamed = materialize(with_ordinal(pairs, "key").select("key", (F.col("ordinal") + F.lit(top + 1)).alias("new")), "renamed")
    named = marked.join(F.broadcast(renamed) if fits_broadcast(renamed) else renamed, "key", "left")
    return named.select("_doc", "text", "key.t", F.coalesce("new", "key.id").alias("own"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input without all but one document of every group of near-duplicates.

    Rows without id stay; of rows that repeat a kept id with the same text, one stays.
    Different texts of one id are documents each, so none is lost to the other's group.
    """
    require_whole_numbers(docs, id_col)
    named = _own_ids(docs, id_col, text_col)
    judged = near_duplicates(named, "own", "text", **options)
    kept = judged.filter(F.col("kept") & F.col("own").isNotNull()).select("own").distinct()
    again = Window.partitionBy("own").orderBy("t")
    one = named.join(kept, "own", "left_semi").withColumn("_again", F.row_number().over(again)).filter("_again = 1")
    return one.select("_doc.*").union(docs.filter(F.col(f"`{id_col}`").isNull()))
