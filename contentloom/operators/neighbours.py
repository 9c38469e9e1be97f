"""Nearest neighbours of dense vectors over an index of k-means cells."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from contentloom.session import written

#: Rows that the cells are fitted on, at most on average.
SAMPLE_ROWS = 20_000
#: Rows of a cell on average, number of cells at most, rows of a part of a cell on average.
CELL_ROWS, MAX_CELLS, PART_ROWS = 512, 1024, 2048
#: Rows of a block on average, at least; a large table has so many blocks, of so many bytes at
#: most: a query is sent to a block of rows at once, a row to a block of queries.
BLOCK_ROWS, BLOCKS, BLOCK_BYTES = 8192, 12, 32 << 20
#: Cosines that a task holds at once.
AT_ONCE = 1 << 20
#: Cosines are compared and returned with so many decimals.
DECIMALS = 6
_SLACK = 10.0**-DECIMALS


@dataclass(frozen=True)
class Cells:
    """Per cell: its unit centroid, the cosine of the member that is furthest from it, the
    number of its parts, of its members."""

    centroids: np.ndarray
    furthest: np.ndarray
    parts: np.ndarray
    sizes: np.ndarray


@dataclass(frozen=True)
class VectorIndex:
    """``rows``: row, key, vec (unit length), cell, part."""

    rows: DataFrame
    cells: Cells


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], column.type)
    sizes = np.diff(np.asarray(lists.offsets))
    values = np.asarray(lists.flatten(), float)
    if len(values) == len(sizes) * width:
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _picked(values: Sequence[int], cell: str) -> Column:
    """The value of a cell, from a list as one constant."""
    return F.get(F.from_json(F.lit(json.dumps([int(v) for v in values])), "array<int>"), F.col(cell))


def _slices(rows: int, width: int) -> Iterator[slice]:
    step = max(1, AT_ONCE // max(1, width))
    return (slice(i, i + step) for i in range(0, rows, step))


@dataclass(frozen=True)
class Blocks:
    """Cells gathered to blocks of bounded size: per cell its first block and the number of
    blocks that share its rows."""

    start: np.ndarray
    count: np.ndarray

    def of(self, cell: str, row: str) -> Column:
        share = F.pmod(F.xxhash64(row), _picked(self.count, cell))
        return (_picked(self.start, cell) + share).cast("int")


def _travel_rows(rows: int, width: int) -> int:
    """Rows of a block that travels. The rows travel as often as there are blocks of queries,
    so blocks grow with the table until they have ``BLOCK_BYTES``."""
    return max(BLOCK_ROWS, min(-(-rows // BLOCKS), BLOCK_BYTES // (8 * width)))


def _blocks(centroids: np.ndarray, sizes: np.ndarray, rows: int) -> Blocks:
    """Neighbouring cells, along the direction in which centroids differ most, share a block
    of ``rows``; a cell of more rows than a block has several of its own."""
    spread = centroids - centroids.mean(axis=0)
    axis = np.linalg.eigh(spread.T @ spread)[1][:, -1]
    start, count = np.zeros(len(sizes), int), np.ones(len(sizes), int)
    block, room = 0, rows
    for cell in np.argsort(spread @ axis, kind="stable"):
        if sizes[cell] > room and room < rows:
            block, room = block + 1, rows
        start[cell], count[cell] = block, max(1, -(-sizes[cell] // rows))
        room -= sizes[cell]
        if room <= 0:
            block, room = block + count[cell], rows
    return Blocks(start, count)


def _centroids(rows: DataFrame, width: int, cells: int, fraction: float, seed: int) -> np.ndarray:
    if cells < 2:
        return np.eye(1, width)
    padding = F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vec"))
    sample = rows if fraction >= 1 else rows.sample(fraction, seed)
    features = sample.select(array_to_vector(F.concat("vec", padding)).alias("features"))
    model = KMeans(k=cells, distanceMeasure="cosine", maxIter=8, seed=seed).fit(features)
    found = np.array(model.clusterCenters())
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def build_vector_index(
    vectors: DataFrame,
    key: str,
    vector: str,
    *,
    cells: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> VectorIndex:
    """Deal every vector to the cell of its nearest centroid and write it there.

    The centroids are fitted on about ``sample_rows`` rows; all rows are indexed. NULL and
    zero vectors and those with NULL or non-finite components have no direction and are not
    in the index; shorter vectors count as ending in zeros.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    fit = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    largest = F.array_max(F.transform("vec", F.abs))
    # Scaled by the largest component first, so that squares neither vanish nor overflow.
    scaled = F.transform("vec", lambda e: e / F.col("_largest"))
    rows = (
        vectors.filter(x.isNotNull() & fit)
        .select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"), x.alias("vec"))
        .withColumn("_largest", largest)
        .filter("_largest > 0")
        .select("row", "key", scaled.alias("vec"))
    )
    rows = written(rows, "vectors")
    total, width = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    cells = cells or max(1, min(MAX_CELLS, total // CELL_ROWS))
    centroids = _centroids(rows, width or 1, cells, sample_rows / max(total, 1), seed)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _matrix(batch.column("vec"), centroids.shape[1])
            unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
            cell, least = np.empty(len(unit), int), np.empty(len(unit))
            for some in _slices(len(unit), len(centroids)):
                near = unit[some] @ centroids.T
                cell[some], least[some] = near.argmax(axis=1), near.max(axis=1)
            offsets = pa.array(np.arange(len(unit) + 1) * centroids.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("key"),
                    pa.ListArray.from_arrays(offsets, pa.array(unit.ravel())),
                    pa.array(cell, pa.int32()),
                    pa.array(least),
                ],
                names=["row", "key", "vec", "cell", "near"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    dealt = written(rows.mapInArrow(assign, f"row long, key {kind}, vec array<double>, cell int, near double"), "cells")
    furthest, parts, sizes = np.ones(len(centroids)), np.zeros(len(centroids), int), np.zeros(len(centroids), int)
    for r in dealt.groupBy("cell").agg(F.min("near").alias("near"), F.count("*").alias("n")).collect():
        furthest[r["cell"]], parts[r["cell"]], sizes[r["cell"]] = r["near"], -(-r["n"] // PART_ROWS), r["n"]
    part = F.pmod(F.xxhash64("row"), _picked(parts, "cell")).cast("int").alias("part")
    return VectorIndex(dealt.select("row", "key", "vec", "cell", part), Cells(centroids, furthest, parts, sizes))


def _reachable(
    unit: np.ndarray, theta: np.ndarray, cells: Cells, probes: int | None, which: slice | list[int] = slice(None)
) -> np.ndarray:
    """Which cells can hold a vector that is nearer than ``theta``.

    A member is at least as far from the vector as their distances to the centroid differ.
    ``probes`` limits that to the cells of the nearest centroids.
    """
    near = np.clip(unit @ cells.centroids.T, -1, 1)
    a, b = near[:, which], np.clip(cells.furthest[which], -1, 1)
    bound = np.where(a >= b, 1.0, a * b + np.sqrt((1 - a * a) * (1 - b * b)))
    can = (bound + _SLACK >= theta[:, None]) & (cells.parts[which] > 0)
    if probes is not None and probes < near.shape[1]:
        can &= a >= np.partition(near, -probes, axis=1)[:, [-probes]]
    return can


def _thresholds(asking: pa.Table, members: pa.Table, width: int, k: int) -> np.ndarray:
    """The cosine that k of the members reach, per query, the query's own row left out;
    -inf for fewer members."""
    unit, other = _matrix(asking["vec"], width), _matrix(members["vec"], width)
    own, rows = asking["row"].to_numpy(), members["row"].to_numpy()
    theta = np.full(len(unit), -np.inf)
    for some in _slices(len(unit), len(rows) if len(rows) > k else AT_ONCE):
        if len(rows) > k:
            cosines = np.round(unit[some] @ other.T, DECIMALS)
            cosines[own[some][:, None] == rows] = -np.inf
            theta[some] = np.partition(cosines, -k, axis=1)[:, -k]
    return theta


def _best(queries: pa.Table, members: pa.Table, cells: Cells, k: int, probes: int | None = None) -> pa.Table:
    """The k nearest members of every query that can find some here."""
    width = cells.centroids.shape[1]
    # Queries of a cell reach the same cells, so they are compared together.
    queries = queries.sort_by("cell")
    unit, floor = _matrix(queries["vec"], width), queries["theta"].to_numpy()
    q_rows, rows = queries["row"].to_numpy(), members["row"].to_numpy()
    other = _matrix(members["vec"], width)
    # Products of single precision rule out most pairs; the others are computed again.
    rough, rough_other = unit.astype(np.float32), other.astype(np.float32)
    slack = _SLACK + (width + 8) * float(np.finfo(np.float32).eps)
    here, which = np.unique(members["cell"].to_numpy(), return_inverse=True)
    keys = members["key"].combine_chunks() if isinstance(members["key"], pa.ChunkedArray) else members["key"]
    order_of_key = np.empty(len(rows), int)
    order_of_key[np.asarray(pa.compute.sort_indices(keys))] = np.arange(len(rows))
    found = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
    for some in _slices(len(unit), max(len(rows), len(cells.centroids))):
        can = _reachable(unit[some], floor[some], cells, probes, list(here))
        wanted = can.any(axis=0)[which]
        there = np.flatnonzero(wanted)
        cosines = rough[some] @ (rough_other if wanted.all() else rough_other[there]).T
        least = (floor[some, None] - slack).astype(np.float32)
        at, to = np.divmod(np.flatnonzero((cosines >= least).ravel()), max(1, len(there)))
        if probes is not None:
            right = can[at, which[there[to]]]
            at, to = at[right], to[right]
        at, to = some.start + at, there[to]
        got = np.empty(len(at))
        for few in _slices(len(at), width):
            got[few] = np.einsum("ij,ij->i", unit[at[few]], other[to[few]])
        got = np.round(got, DECIMALS)
        right = (got >= floor[at] - _SLACK) & (q_rows[at] != rows[to])
        at, to, got = at[right], to[right], got[right]
        place = np.lexsort((rows[to], order_of_key[to], -got, at))
        at, to, got = at[place], to[place], got[place]
        best = np.arange(len(at)) - np.searchsorted(at, at, side="left") < k
        found.append((at[best], to[best], got[best]))
    at, to, got = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.table(
        {"query": pa.array(q_rows[at]), "row": pa.array(rows[to]), "key": keys.take(pa.array(to)), "similarity": pa.array(got)}
    )


def nearest_neighbours(
    index: VectorIndex, k: int, *, queries: Column | None = None, probes: int | None = None
) -> DataFrame:
    """The k nearest vectors, by cosine, of every indexed row, or of those that ``queries``
    picks by ``key``: query_id, rank, neighbour_id, similarity (rounded; ties by id).

    The rows of its own block give a query a cosine that k of them reach. It then visits those
    cells only that can hold a nearer vector, so the result is exact. With ``probes`` it
    visits at most the cells of so many nearest centroids, see ``probes_for``, and starts
    from its part of its own cell.

    Cells and queries travel in blocks of bounded size, a block of rows once for each block
    of queries that visits it. A task holds a bounded number of cosines at a time, and only
    the k best are passed on.
    """
    kind = index.rows.schema["key"].dataType.simpleString()
    schema = f"query long, row long, key {kind}, similarity double"
    members, cells = index.rows, index.cells
    width = cells.centroids.shape[1]
    asks = F.lit(True) if queries is None else F.coalesce(queries, F.lit(False))

    def own(table: pa.Table) -> pa.Table:
        asking = table.filter(table["asks"])
        theta = pa.array(_thresholds(asking, table, width, k))
        return asking.select(["row", "cell", "vec"]).append_column("theta", theta)

    near = ["part"] if probes is None else ["cell", "part"]
    marked = members.withColumn("asks", asks)
    if probes is None:
        marked = marked.withColumn("part", _blocks(cells.centroids, cells.sizes, BLOCK_ROWS).of("cell", "row"))
    of_rows = _blocks(cells.centroids, cells.sizes, _travel_rows(int(cells.sizes.sum()), width))
    members = members.withColumn("block", of_rows.of("cell", "row"))
    asked = marked.groupBy(*near).applyInArrow(own, "row long, cell int, vec array<double>, theta double")
    asked = written(asked, "queries")
    sizes = np.zeros(len(cells.sizes), int)
    for r in asked.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    of_queries = _blocks(cells.centroids, sizes, _travel_rows(int(sizes.sum()), width))
    asked = asked.withColumn("q_block", of_queries.of("cell", "row"))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, theta = _matrix(batch.column("vec"), width), batch.column("theta").to_numpy()
            q_block = batch.column("q_block").to_numpy()
            seen: set[tuple[int, int]] = set()
            for some in _slices(len(unit), len(cells.centroids)):
                can = _reachable(unit[some], theta[some], cells, probes)
                for b in np.unique(q_block[some]).tolist():
                    for c in np.flatnonzero(can[q_block[some] == b].any(axis=0)).tolist():
                        seen.update((b, int(of_rows.start[c]) + i) for i in range(of_rows.count[c]))
            pairs = np.array(sorted(seen), int).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, i], pa.int32()) for i in range(2)], names=pair)

    pair = ["q_block", "block"]
    visits = written(asked.mapInArrow(reach, "q_block int, block int").distinct(), "visits")
    left = asked.join(visits, "q_block").select(*pair, "row", "cell", "vec", "theta")
    right = members.join(visits, "block").select(*pair, "row", "key", "vec", "cell")

    def visit(one: pa.Table, two: pa.Table) -> pa.Table:
        return _best(one, two, cells, k, probes)

    found = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(visit, schema)
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "key", "row")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ids = members.select(F.col("row").alias("query"), F.col("key").alias("query_id"))
    return best.join(ids, "query").select("query_id", "rank", F.col("key").alias("neighbour_id"), "similarity")


def probes_for(index: VectorIndex, k: int, recall: float, *, sample: int = 200) -> int:
    """Number of cells that finds a share ``recall`` of the k nearest, by the exact result of
    about ``sample`` rows."""
    total = index.rows.count()
    share = F.pmod(F.xxhash64("key", F.lit("probe")), F.lit(1 << 20)) < (sample << 20) // max(total, sample)
    found = nearest_neighbours(index, k, queries=share)
    here = index.rows.select(F.col("key").alias("query_id"), F.col("vec").alias("q"))
    there = index.rows.select(F.col("key").alias("neighbour_id"), F.col("cell"))
    rows = found.join(here, "query_id").join(there, "neighbour_id").select("q", "cell").collect()
    if not rows:
        return 1
    near = np.array([r["q"] for r in rows]) @ index.cells.centroids.T
    cells = np.array([r["cell"] for r in rows])
    rank = (near > near[np.arange(len(rows)), cells][:, None]).sum(axis=1)
    return int(np.quantile(rank, recall, method="higher")) + 1
