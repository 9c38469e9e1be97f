"""Lines that many documents repeat, dropped by keep bitmaps. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from contentloom.functions.core import let
from contentloom.llm.common import ascii_lower, materialize
from contentloom.operators.lookup import fits_broadcast, lookup

# Fixed value: the white space that a key has at neither end.
SPACES = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5


def lines_of(text: Column) -> Column:
    """The lines of a text; NULL and the empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """h (128 bits of the key), doc, t (hash of the text), pos of every line with a long key.

    Lines are hashed where their text is read; no text leaves its task.
    """
    text = F.col(f"`{text_col}`")
    split = docs.select(
        F.col(f"`{id_col}`").alias("doc"), _text_hash(text).alias("t"), lines_of(text).alias("lines")
    )
    rows = split.select("doc", "t", F.posexplode("lines").alias("pos", "line"))
    stripped = F.btrim("line", F.lit(SPACES))
    key = ascii_lower(stripped)
    h = F.struct(F.xxhash64(F.lit(1), key).alias("a"), F.xxhash64(F.lit(2), key).alias("b"))
    rows = rows.filter(F.char_length(stripped) >= min_chars).select(h.alias("h"), "doc", "t", "pos")
    return materialize(rows, "lines")


def repeated_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """h, keeper (greatest document), n (documents) of the keys of ``min_docs`` documents.

    Hashes are dealt to ranges with their documents, so a key of very many documents is cut
    between documents. Within a range, sorted by hash, document and position, each
    document's first occurrence of a key passes on. First occurrences are counted in every
    task before the counts are shuffled.
    """
    ranges = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_doc = Window.partitionBy("h", "doc").orderBy("t", "pos")
    firsts = (
        lines.repartitionByRange(ranges, "h", "doc")
        .withColumn("_nth", F.row_number().over(in_doc))
        .filter("_nth = 1")
    )
    counted = firsts.groupBy("h").agg(F.max("doc").alias("keeper"), F.count("*").alias("n"))
    return materialize(counted.filter(F.col("n") >= min_docs), "repeated")


def _keep_runs(n_lines: Column, starts: str, ends: str) -> Column:
    """Runs of kept lines between the runs of dropped ones."""
    zero = F.lit(0)
    run = lambda i: F.struct(
        F.when(i == 0, zero).otherwise(F.get(ends, i - 1) + 1).alias("start"),
        (
            F.coalesce(F.get(starts, i), n_lines) - F.when(i == 0, zero).otherwise(F.get(ends, i - 1) + 1)
        ).alias("length"),
    )
    runs = F.transform(F.sequence(zero, F.size(starts)), run)
    return F.filter(runs, lambda r: r["length"] > 0)


def dropped_runs(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """k (document and text), starts, ends, n_dropped of documents that lose lines.

    Copies of one row share a bitmap, as both its lines and its id are the same.
    """
    gone = lookup(lines, repeated, "h", "doc", weight="n", materialized=True).filter(
        ~F.col("doc").eqNullSafe(F.col("keeper"))
    )
    at = gone.groupBy(F.struct("doc", "t").alias("k")).agg(F.array_sort(F.collect_set("pos")).alias("at"))
    begins = lambda x, i: (i == 0) | (F.get("at", i - 1) != x - 1)
    stops = lambda x, i: F.coalesce(F.get("at", i + 1) != x + 1, F.lit(True))
    return materialize(
        at.select(
            "k",
            F.filter("at", begins).alias("starts"),
            F.filter("at", stops).alias("ends"),
            F.size("at").cast("long").alias("n_dropped"),
        ),
        "dropped",
    )


def line_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    keep: list[str] | None = None,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Which lines of every document stay, when a line that many documents repeat stays only
    in the greatest document that holds it.

    A line's key is the line without white space at its ends, A-Z lower-cased; keys of
    ``min_chars`` code points or more in ``min_docs`` documents or more count as repeated.
    One row per input row: the id (and the columns of ``keep``), n_lines, n_dropped, and
    ``bitmap``, the keep bitmap compressed to runs (start, length) of kept lines from 0.

    NULL and empty texts are one empty line, which stays; rows of one id are one document,
    and rows without id are one that is smaller than all others; repeated rows get the same
    answer each; an empty table gives no rows; other columns are ignored. Bitmaps are
    broadcast to the rows if their measured size allows it, else both are shuffled once.
    """
    lines = hashed_lines(docs, id_col, text_col, min_chars)
    gone = dropped_runs(lines, repeated_keys(lines, min_docs))
    text = F.col(f"`{text_col}`")
    names = list(dict.fromkeys([id_col, *(keep or [])]))
    rows = docs.select(
        F.struct(F.col(f"`{id_col}`").alias("doc"), _text_hash(text).alias("t")).alias("k"),
        F.size(lines_of(text)).alias("_lines"),
        *[F.col(f"`{c}`").alias(f"_keep_{c}") for c in names],
    )
    joined = rows.join(F.broadcast(gone) if fits_broadcast(gone) else gone, "k", "left")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("_lines").alias("length")))
    return joined.select(
        *[F.col(f"_keep_{c}").alias(c) for c in names],
        F.col("_lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("n_dropped").isNull(), whole)
        .otherwise(_keep_runs(F.col("_lines"), "starts", "ends"))
        .alias("bitmap"),
    )


def kept_text(text: Column, bitmap: Column) -> Column:
    """The lines that a bitmap keeps, joined again."""
    return let(
        lines_of(text),
        lambda lines: F.array_join(
            F.flatten(F.transform(bitmap, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n"
        ),
    )
