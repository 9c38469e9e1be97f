"""Best-fit packing of tokenised documents, planned over a histogram of lengths."""

from __future__ import annotations

import base64
import math
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from contentloom.llm.common import materialize, slim

MAX_TOKENS = 2048
END_ID = 0
#: Texts of these characters only are split into the same words by both tokenizer
#: libraries, whichever Unicode version they were built with.
_PLAIN = re.compile("[^\x00-\x1b\x20-ɏ‐-…]")


@lru_cache(maxsize=4)
def _encoder(tokenizer_path: str, ranks_path: str | None, pattern: str | None):
    """text -> ids, loaded once per Python worker.

    With the same vocabulary given as ranks, plain texts take the faster library; texts with
    a special token's string or unusual characters take the tokenizer file itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    if ranks_path is None:
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if _PLAIN.search(text) or any(s in text for s in special):
            return tokenizer.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def token_pieces(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    tokenizer_path: str,
    ranks_path: str | None = None,
    pattern: str | None = None,
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Tokenise whole texts, close each with ``end_id`` and cut the longer ones.

    Only documents of more than ``max_tokens`` ids are cut; every piece but the first is
    full. A NULL text counts as empty: one piece with the end alone. One row per piece:
    id, piece, start, length, ids_crc32 and, if asked for, the ids.
    """
    source = slim(docs, id=id_col, text=text_col)
    id_type = source.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, piece int, start long, length int, ids_crc32 long"
    if keep_ids:
        schema += ", ids array<int>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path, ranks_path, pattern)
        for batch in batches:
            owner, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = array("I", encode(text.as_py() or ""))
                ids.append(end_id)
                n = len(ids)
                first = n if n <= max_tokens else n % max_tokens or max_tokens
                bounds = [0, *range(first, n + 1, max_tokens)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    owner.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(memoryview(ids)[a:b]))
                    if keep_ids:
                        kept.append(ids[a:b].tolist())
            columns = [
                batch.column(0).take(pa.array(owner, pa.int32())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int32()),
                pa.array(crc, pa.int64()),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(cut, schema)


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple]:
    """Best-fit decreasing over counts of lengths.

    Items of one length are alike, so runs of equal sequences are filled together: the
    work depends on the number of lengths (``capacity`` at most), not of documents.
    Returns slots (length, first rank, end rank, first sequence, items per sequence, offset),
    ordered by length and rank.
    """
    slots = []
    free: dict[int, list[tuple[int, int, int]]] = {}  # room -> runs (first, number, fill)
    sequences = 0
    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        left, rank = counts[length], 0

        def fill(first: int, number: int, used: int) -> tuple[int, int]:
            """Put items into a run of equal sequences; what is left of items and ranks."""
            nonlocal left, rank
            per = (capacity - used) // length
            full = min(number, left // per)
            if full:
                slots.append((length, rank, rank + full * per, first, per, used))
                end = used + per * length
                free.setdefault(capacity - end, []).append((first, full, end))
                rank += full * per
                left -= full * per
            if full < number and left:
                slots.append((length, rank, rank + left, first + full, per, used))
                end = used + left * length
                free.setdefault(capacity - end, []).append((first + full, 1, end))
                rank += left
                left = 0
                full += 1
            if full < number:
                free.setdefault(capacity - used, []).append((first + full, number - full, used))
            return left, rank

        for room in sorted(r for r in free if r >= length):
            for run in free.pop(room):
                if left:
                    fill(*run)
                else:
                    free.setdefault(room, []).append(run)
            if not left:
                break
        if left:
            number = -(-left // (capacity // length))
            fill(sequences, number, 0)
            sequences += number
    return sorted(slots)


def pack(pieces: DataFrame, capacity: int = MAX_TOKENS) -> DataFrame:
    """Give every piece its sequence and offset.

    ``pieces`` (with ``id``, ``piece`` and ``length``) must be cheap to read again. The
    histogram has ``capacity`` rows at most and is all the driver sees. Ranks within a
    length come from about sqrt(rows) blocks per length, numbered apart and added up, so a
    length that a third of all pieces share is not ranked in one task. Pieces that agree in
    everything take each other's places.
    """
    total = pieces.count()
    blocks = max(1, math.isqrt(total))
    placed = pieces.withColumn(
        "block", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(blocks)).cast("int")
    )
    sizes = placed.groupBy("length", "block").agg(F.count("*").alias("n"))
    counts = {
        r["length"]: r["n"]
        for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    slots = plan_best_fit(counts, capacity)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("length", "block").orderBy("id", "piece", "ids_crc32")
    ranked = (
        placed.withColumn("rank", F.row_number().over(within) - 1)
        .join(offsets, ["length", "block"])
        .withColumn("rank", F.col("rank") + F.col("before"))
        .drop("block", "before")
    )
    return _take_slots(ranked, slots)


def _take_slots(ranked: DataFrame, slots: list[tuple]) -> DataFrame:
    """Join on (length, rank) with the planned slots, which are ranges of ranks."""
    out = ranked.drop("rank").columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name in out)
    starts = [s[:2] for s in slots]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = [], []
            lengths, ranks = batch.column("length"), batch.column("rank")
            for length, rank in zip(lengths.to_pylist(), ranks.to_pylist(), strict=True):
                _, low, _, first, per, used = slots[bisect_right(starts, (length, rank)) - 1]
                sequence.append(first + (rank - low) // per)
                offset.append(used + (rank - low) % per * length)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in out), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*out, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    tokenizer_path: str,
    ranks_path: str | None = None,
    pattern: str | None = None,
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """Tokenise, cut and pack all documents.

    One row per piece: the id column, piece, start, length, ids_crc32, sequence_id, offset.
    NULL ids are kept as they are, repeated rows are packed each, an empty table gives no
    rows, further columns are ignored.
    """
    pieces = materialize(
        token_pieces(docs, id_col, text_col, tokenizer_path, ranks_path, pattern, max_tokens),
        "pieces",
    )
    return pack(pieces, max_tokens).select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )
