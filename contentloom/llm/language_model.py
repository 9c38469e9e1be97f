"""Bigram language model by deleted interpolation, counted over the whole corpus."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from contentloom.llm.common import in_other_part, is_part, materialize

#: Characters of text in a block, about: what one task tokenises at a time.
BLOCK_CHARS = 12_000_000
#: Characters of the corpus per range of n-gram hashes, about: what one task adds up.
RANGE_CHARS = 8_000_000
#: Part of the training rows (of ``held_parts``) whose counts the weights are learned on.
DELETED_PART = 5
#: Contexts seen 0, 1, 2-3, 4-7, ... times have weights of their own, up to the last bucket.
BUCKETS = 24
#: Steps per power of ten in which the estimates of held-out tokens are counted for EM.
STEPS = 20
ABSENT = -1_000
EM_ROUNDS = 100

END = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_M = np.uint64(0xFF51AFD7ED558CCD)


def tokens(text: str | None) -> np.ndarray:
    """64-bit hashes of the words (A-Z lower-cased, split at ASCII white space) and the end."""
    digest = xxhash.xxh3_64_intdigest
    words = (text or "").encode().lower().split()
    return np.array([*map(digest, words), int(END)], np.uint64)


def _pairs(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    x = before * _A + token * _B
    x = (x ^ (x >> np.uint64(32))) * _M
    return x ^ (x >> np.uint64(29))


def _planes(values: np.ndarray) -> bytes:
    """Bytes by significance: small numbers leave planes of zeros, which compress."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def _values(planes: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = np.frombuffer(planes, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).view(dtype).reshape(-1)


class _Block:
    """The tokens of a block's documents, one document after the other."""

    def __init__(self, rows: pd.DataFrame):
        each = [tokens(t) for t in rows["text"]]
        self.sizes = np.array([len(t) for t in each], np.int64)
        self.token = np.concatenate(each)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[self.starts] = END  # documents begin where others have ended
        self.pair = _pairs(before, self.token)
        self.trained = np.repeat(rows["trained"].to_numpy(bool), self.sizes)

    def grams(self, order: int) -> np.ndarray:
        return self.token if order == 1 else self.pair


def _bounds(ranges: int) -> np.ndarray:
    return np.array([-(-(i << 64) // ranges) for i in range(1, ranges)], np.uint64)


def gather(docs: DataFrame, ranges: int) -> DataFrame:
    """block, order, range, grams, n: every block's distinct n-grams, sorted, with the
    number of their training occurrences, cut into ranges of hashes."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        block, out = _Block(rows), []
        for order in (1, 2):
            grams, inverse = np.unique(block.grams(order), return_inverse=True)
            n = np.bincount(inverse, weights=block.trained, minlength=len(grams)).astype(np.uint32)
            cuts = [0, *np.searchsorted(grams, _bounds(ranges)), len(grams)]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if a < b:
                    steps = np.diff(grams[a:b], prepend=np.uint64(0))
                    out.append((rows["block"].iloc[0], order, i, _planes(steps), _planes(n[a:b])))
        return pd.DataFrame(out, columns=["block", "order", "range", "grams", "n"])

    schema = "block long, order int, range int, grams binary, n binary"
    return docs.groupBy("block").applyInPandas(run, schema)


def add_up(gathered: DataFrame) -> DataFrame:
    """The corpus counts of every block's n-grams, in the block's order.

    ``total`` counts all training occurrences, ``main`` (for the deleted part's blocks) all
    but the deleted part's. One row of each range carries its sums: ``mass`` and ``kinds``
    of all occurrences, ``main_mass`` of the main ones. A range holds a fixed share of all
    hashes, and each block sends a frequent n-gram once.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        grams = [np.cumsum(_values(g, np.uint64), dtype=np.uint64) for g in rows["grams"]]
        n = [_values(x, np.uint32) for x in rows["n"]]
        deleted = (rows["block"] % 2 == 1).to_numpy()
        kinds, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        sizes = [len(g) for g in grams]
        every = np.concatenate(n).astype(np.float64)
        total = np.bincount(inverse, weights=every, minlength=len(kinds))
        main = np.bincount(
            inverse, weights=every * ~np.repeat(deleted, sizes), minlength=len(kinds)
        )
        ends = np.cumsum(sizes)
        out = []
        for i, (block, a, b) in enumerate(zip(rows["block"], ends - sizes, ends, strict=True)):
            own = inverse[a:b]
            sums = (int(total.sum()), int((total > 0).sum()), int(main.sum())) if i == 0 else (0, 0, 0)
            out.append(
                (
                    block,
                    rows["order"].iloc[0],
                    rows["range"].iloc[0],
                    _planes(total[own].astype(np.uint64)),
                    _planes(main[own].astype(np.uint64)) if deleted[i] else None,
                    *sums,
                )
            )
        names = ["block", "order", "range", "total", "main", "mass", "kinds", "main_mass"]
        return pd.DataFrame(out, columns=names)

    schema = (
        "block long, order int, range int, total binary, main binary, "
        "mass long, kinds long, main_mass long"
    )
    return materialize(gathered.groupBy("order", "range").applyInPandas(run, schema), "ngrams")


def _looked_up(block: _Block, counts: pd.DataFrame, column: str) -> tuple[np.ndarray, ...]:
    """Per token the counts of pair, context and token, and the number of documents."""
    per_token = {}
    for order in (1, 2):
        own = counts[counts["order"] == order].sort_values("range")[column]
        known = np.concatenate([_values(x, np.uint64) for x in own]).astype(np.float64)
        kinds, inverse = np.unique(block.grams(order), return_inverse=True)
        per_token[order] = known[inverse]
        if order == 1:
            documents = known[np.searchsorted(kinds, END)]
    context = np.empty_like(per_token[1])
    context[1:] = per_token[1][:-1]
    context[block.starts] = documents
    return per_token[2], context, per_token[1]


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context)[1], BUCKETS - 1)  # 0 for 0, 1 for 1, 2 for 2-3, ...


def held_out_counts(docs: DataFrame, counts: DataFrame, main_mass: int) -> list:
    """How often the deleted part has tokens of which estimates, by context bucket.

    Pair and token estimates are rounded to ``STEPS`` per power of ten, so the table's size
    depends on their range only and not on the corpus.
    """

    def run(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        pair, context, token = _looked_up(_Block(rows), own, "main")
        with np.errstate(divide="ignore", invalid="ignore"):
            estimates = [np.where(context > 0, pair / context, 0), token / max(main_mass, 1)]
            p2, p1 = (
                np.where(p > 0, np.rint(STEPS * np.log10(p)), ABSENT).astype(np.int64) for p in estimates
            )
        frame = pd.DataFrame({"bucket": _bucket(context), "p2": p2, "p1": p1})
        return frame.groupby(["bucket", "p2", "p1"]).size().reset_index(name="n")

    seen = (
        docs.groupBy("block")
        .cogroup(counts.groupBy("block"))
        .applyInPandas(run, "bucket long, p2 long, p1 long, n long")
    )
    return seen.groupBy("bucket", "p2", "p1").agg(F.sum("n").alias("n")).collect()


def learn_weights(held_out: list, kinds: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """EM: per bucket the weights of pair, token and uniform estimates.

    One token of each kind is added, so that no weight is 0 (but the pair's in bucket 0,
    where it estimates nothing). A bucket that the held-out tokens lack takes the weights of
    the next rarer one.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    back = lambda v: np.where(v == ABSENT, 0.0, 10.0 ** (v / STEPS))
    for bucket in range(BUCKETS):
        rows = np.array([(r["p2"], r["p1"], r["n"]) for r in held_out if r["bucket"] == bucket], float)
        if not len(rows):
            if bucket > 1:
                weights[bucket] = weights[bucket - 1]
            continue
        p = np.stack([back(rows[:, 0]), back(rows[:, 1]), np.full(len(rows), 1 / (kinds + 1))], axis=1)
        one = (weights[bucket] > 0).astype(float)
        for _ in range(rounds):
            share = p * weights[bucket]
            share /= share.sum(axis=1, keepdims=True)
            got = (share * rows[:, 2:]).sum(axis=0) + one
            weights[bucket] = got / got.sum()
    return weights


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    held_parts: int = 7,
    held_part: int = 2,
    deleted_part: int = DELETED_PART,
) -> DataFrame:
    """log10 probability of every whole text.

    p(w | h) = a * c(hw) / c(h) + b * c(w) / N + c * 1 / (V + 1), with weights by how often
    the context h was seen, learned by EM on the deleted part's tokens under the counts of
    the other training rows; the final counts are of all training rows. The first word's
    context is a document's beginning.

    One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigrams), score. NULL text is empty (the end token alone); a row without id is scored
    but neither held out nor learned from; repeated rows count each; an empty table gives no
    rows; other columns are ignored. Texts go to blocks by the hash of the row. Only distinct
    n-grams of a block, as bytes, and their counts travel, to tasks that each own a range of
    hashes; both numbers follow the corpus size.
    """
    source = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    chars = source.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks, ranges = (int(-(-chars // n)) or 1 for n in (BLOCK_CHARS, RANGE_CHARS))
    deleted = is_part("id", held_parts, deleted_part)
    number = F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) * 2 + deleted.cast("long")
    placed = source.select(
        "id",
        "text",
        is_part("id", held_parts, held_part).alias("held"),
        in_other_part("id", held_parts, held_part).alias("trained"),
        number.alias("block"),
    )
    counts = add_up(gather(placed, ranges))
    sums = counts.filter("order = 1").agg(F.sum("mass"), F.sum("kinds"), F.sum("main_mass")).first()
    mass, kinds, main_mass = (int(x or 0) for x in sums)
    odd = F.col("block") % 2 == 1
    weights = learn_weights(
        held_out_counts(placed.filter(odd), counts.filter(odd), main_mass), kinds
    )

    def run(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        block = _Block(rows)
        pair, context, token = _looked_up(block, own, "total")
        w = weights[_bucket(context)]
        p = w[:, 1] * token / max(mass, 1) + w[:, 2] / (kinds + 1)
        p += w[:, 0] * pair / np.maximum(context, 1)
        add = lambda x: np.add.reduceat(x, block.starts)
        return pd.DataFrame(
            {
                "id": rows["id"],
                "held_out": rows["held"],
                "n_tokens": block.sizes,
                "n_known": add((token > 0).astype(np.int64)),
                "train_tokens": mass,
                "base_score": add(np.log10((token + 1) / (mass + kinds + 1))),
                "score": add(np.log10(p)),
            }
        )

    id_type = source.schema["id"].dataType.simpleString()
    schema = (
        f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    scored = placed.groupBy("block").cogroup(counts.groupBy("block")).applyInPandas(run, schema)
    return scored.withColumnRenamed("id", id_col)
