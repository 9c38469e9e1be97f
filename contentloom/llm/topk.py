"""Exact top-k inner products by norm-bucketed retrieval."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from contentloom.llm.common import materialize

#: Classes of vector length, and rows of a task's share of a class and of a block of queries.
CLASSES = 64
PART_ROWS = 4096
QUERY_ROWS = 8192
#: Products computed at a time within a task.
CHUNK = 256
#: Candidates are looked up by coordinate if that leaves less than this share of the prefix.
COORDINATE_GAIN = 0.5
_SAFE = 1 - 1e-9


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros. Integers beyond 2^53 stay exact."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products; Python integers where doubles could round."""
    bound = queries.shape[1] * np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0)
    if bound < 2**53:
        return (queries @ candidates.T).astype(np.int64)
    exact = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return exact(queries) @ exact(candidates).T


def search_bucket(queries: pd.DataFrame, bucket: pd.DataFrame, k: int) -> pd.DataFrame:
    """Candidates of one bucket that can be among the k best of a query.

    ``queries``: row, v, norm, theta (a score that k candidates reach, or None); ``bucket``:
    row, vec_id, v, norm. From theta follows the cosine that a candidate of the bucket's
    greatest length needs. A high one leaves a narrow range of the query's largest
    coordinate, so candidates are looked up in the list sorted by it; otherwise those too
    short are cut off. All that is left is multiplied out.
    """
    bucket = bucket.sort_values("norm", ascending=False, kind="stable").reset_index(drop=True)
    width = max(max(map(len, bucket["v"])), max(map(len, queries["v"])))
    c, q = _matrix(bucket["v"], width), _matrix(queries["v"], width)
    norms, q_norms = bucket["norm"].to_numpy(), queries["norm"].to_numpy()
    theta = queries["theta"].astype(float).fillna(-np.inf).to_numpy()
    longest = norms[0]
    useful = (theta > 0) & (q_norms > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        needed = np.where(useful, theta / q_norms * _SAFE, -np.inf)  # length at cosine 1
        cosine = np.where(useful & (longest > 0), needed / longest, -1.0)
    prefix = np.searchsorted(-norms, -needed, side="right")
    sorted_by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    chosen: dict[int, np.ndarray] = {}
    for i in np.flatnonzero((cosine > 0.3) & (cosine <= 1) & (prefix > 0)):
        unit = q[i] / q_norms[i]
        f = int(np.abs(unit).argmax())
        if f not in sorted_by:
            with np.errstate(divide="ignore", invalid="ignore"):
                values = np.where(norms > 0, c[:, f] / norms, 0.0)
            order = np.argsort(values, kind="stable")
            sorted_by[f] = order, values[order]
        order, values = sorted_by[f]
        t = cosine[i]
        around, slack = unit[f] * t, np.sqrt(max(0.0, (1 - unit[f] ** 2) * (1 - t * t))) + 1e-9
        # A candidate of a larger cosine may lie further out, up to the query's own direction.
        low, high = (around - slack, around + slack)
        if t <= abs(unit[f]):
            low, high = (low, 1.0) if unit[f] > 0 else (-1.0, high)
        a, b = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
        if b - a < COORDINATE_GAIN * prefix[i]:
            chosen[i] = order[a:b]
    hits = []

    def keep(which: np.ndarray, rows: np.ndarray) -> None:
        """Products of some queries with some candidates; the k best of each, ties kept."""
        products = _products(q[which], c[rows])
        floor = theta[which]
        if len(rows) > k and products.dtype != object:
            floor = np.maximum(floor, np.partition(products, len(rows) - k - 1, axis=1)[:, len(rows) - k - 1])
        at, to = np.nonzero(products >= floor[:, None])
        hits.append((which[at], rows[to], products[at, to]))

    plain = np.array([i for i in np.argsort(-prefix, kind="stable") if i not in chosen and prefix[i]], int)
    for at in range(0, len(plain), CHUNK):
        which = plain[at : at + CHUNK]
        keep(which, np.arange(prefix[which[0]]))
    for i, rows in chosen.items():
        if len(rows):
            keep(np.array([i]), rows)
    if not hits:
        return pd.DataFrame({"query": [], "row": [], "vec_id": [], "score": []})
    which, rows, score = (np.concatenate(x) for x in zip(*hits, strict=True))
    found = pd.DataFrame(
        {
            "query": queries["row"].to_numpy()[which],
            "row": bucket["row"].to_numpy()[rows],
            "vec_id": bucket["vec_id"].astype("Int64").to_numpy()[rows],
            "score": score.astype(np.int64),
        }
    )
    found = found[found["query"] != found["row"]]
    best = found.sort_values(["query", "score", "vec_id", "row"], ascending=[True, False, True, True])
    return best.groupby("query", sort=False).head(k)


def vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """row, vec_id, v (whole numbers), norm of the vectors that take part, written once."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    fit = x.isNotNull() & F.forall(
        x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False))
    )

    def floor(y: Column) -> Column:
        """Doubles from 2^53 on are whole; ``floor`` gives a long below."""
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)

    v = F.transform(x, lambda e: floor(e * scale))
    rows = table.filter(fit).select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("vec_id"), v.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e))
    return materialize(rows.withColumn("norm", norm), "vectors")


def _in_classes(rows: DataFrame, total: int) -> tuple[DataFrame, list[float], list[int]]:
    """Rows with the class of their length (0: longest) and their part of it, the greatest
    length and the number of parts of every class.

    Equal lengths share a class, however many there are; parts by hash bound a task's share.
    """
    n = max(1, min(CLASSES, -(-total // PART_ROWS)))
    cuts = []
    if n > 1:
        found = rows.approxQuantile("norm", [i / n for i in range(1, n)], 0.2 / n)
        cuts = sorted(set(found), reverse=True)
    bounds = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<double>")
    classed = rows.withColumn("class", F.size(F.filter(bounds, lambda b: b > F.col("norm"))))
    stats = {r["class"]: (r["longest"], r["n"]) for r in classed.groupBy("class").agg(F.max("norm").alias("longest"), F.count("*").alias("n")).collect()}
    longest = [stats.get(i, (-1.0, 0))[0] for i in range(len(cuts) + 1)]
    parts = [-(-stats.get(i, (0, 0))[1] // PART_ROWS) for i in range(len(cuts) + 1)]
    count = F.get(F.array(*map(F.lit, parts)), F.col("class"))
    return classed.withColumn("part", F.pmod(F.xxhash64("row"), count)), longest, parts


def _search(queries: DataFrame, candidates: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Bring every asked pair of a query block and a part of a class together."""
    key = ["block", "class", "part"]
    asked = queries.select("block", "row", "v", "norm", "theta").join(pairs, "block")
    given = candidates.select("class", "part", "row", "vec_id", "v", "norm").join(pairs, ["class", "part"])
    given = given.select(*[F.col(c).alias(c) for c in given.columns])  # both sides stem from one table
    asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) and len(right):
            return search_bucket(left, right, k)
        return pd.DataFrame({"query": [], "row": [], "vec_id": [], "score": []})

    return asked.groupBy(*key).cogroup(given.groupBy(*key)).applyInPandas(
        run, "query long, row long, vec_id long, score long"
    )


def top_k(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    is_query: Column | None = None,
    k: int = 20,
    scale: int = 64,
) -> DataFrame:
    """The k rows with the greatest inner product of every query row, over all rows.

    Components become floor(scale * x). One row per query and rank: query_id, rank, vec_id,
    score; ties go to the smaller vec_id, a NULL id last. A query's own row is left out, its
    copies are not. NULL vectors and those with NULL or non-finite components take no part;
    shorter vectors count as ending in zeros; rows without id are no queries; an empty
    table gives no rows; other columns are ignored; a score beyond 64 bits is an error.

    The first part of the longest class gives each query a score that k rows reach. Each
    block of queries then visits only the classes whose greatest length can reach it. Both
    sides of a visit are bounded, and a class of equal vectors is as many visits as it needs.
    """
    rows = vectors(table, id_col, vector_col, scale)
    total = rows.count()
    asked = (F.col("vec_id") % 20 == 0) if is_query is None else is_query
    classed, longest, parts = _in_classes(rows, total)
    queries = rows.filter(asked)
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("row", F.lit("q")), F.lit(blocks)))
    seed_class = next((i for i, n in enumerate(parts) if n), 0)
    seed = queries.select("block").distinct().select(
        "block", F.lit(seed_class).alias("class"), F.lit(0).cast("long").alias("part")
    )
    no_theta = F.lit(None).cast("long").alias("theta")
    first = materialize(_search(queries.select("*", no_theta), classed, seed, k), "first")
    reached = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    reached = reached.select(
        F.col("query").alias("row"), F.when(F.col("n") >= k, F.col("least")).alias("theta")
    )
    queries = queries.join(reached, "row", "left")
    reach = F.array(*map(F.lit, longest))
    can = F.filter(
        F.sequence(F.lit(0), F.lit(len(longest) - 1)),
        lambda i: F.col("theta").isNull()
        | (F.col("theta") <= 0)
        | (F.get(reach, i) * F.col("norm") >= F.col("theta") * _SAFE),
    )
    visits = queries.select("block", F.explode(can).alias("class")).distinct()
    count = F.get(F.array(*map(F.lit, parts)), F.col("class"))
    visits = visits.filter(count > 0).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), (count - 1).cast("long")))
    )
    visits = visits.filter((F.col("class") != seed_class) | (F.col("part") != 0))
    rest = _search(queries, classed, materialize(visits, "visits"), k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    best = first.union(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ids = rows.filter(asked).select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return best.join(ids, "query").select("query_id", "rank", "vec_id", "score")
