"""Quality scores by Bradley-Terry ranking of preference pairs."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from contentloom.llm.common import id_part, in_other_part, materialize

#: Labelled rows that the ranking is learned from, about; more are sampled by their id's hash.
MAX_LABELLED = 20_000
#: Preference pairs per row of the larger class.
PARTNERS = 2
REGULARISATION = 1e-5
#: The cut's rank is right to one in so many labelled rows.
ACCURACY = 100_000

_MARKS = np.frombuffer(b"!#$%&*+-/<=>?@\\^_`{|}~\"'(),.:;[]", np.uint8)
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)


def text_features(text: str | None) -> np.ndarray:
    """Shares of characters, words and lines that tell prose from its imitations.

    Every share is given as it is, as a square root and as being there at all, so that a
    linear score can weigh traces and floods apart. Nothing but the whole text is looked at.
    """
    raw = (text or "").encode()
    size = max(len(raw), 1)
    chars = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n = max(len(words), 1)
    seen = Counter(words)
    common = seen.most_common(2)
    lines = raw.split(b"\n")
    line_counts = Counter(lines)
    pairs = Counter(zip(words, words[1:], strict=False)).most_common(1)
    letters = max(int(chars[_UPPER].sum() + chars[_LOWER].sum() + chars[128:].sum()), 1)
    shares = np.array(
        [
            *(chars[_MARKS] / n),
            chars[_UPPER].sum() / letters,
            chars[_DIGIT].sum() / size,
            chars[128:].sum() / size,
            chars[9:14].sum() / size,
            1 - letters / size,
            sum(w.isupper() for w in words) / n,
            sum(len(w) == 1 for w in words) / n,
            1 - len(seen) / n,
            common[0][1] / n if common else 0.0,
            common[1][1] / n if len(common) > 1 else 0.0,
            pairs[0][1] / n if pairs else 0.0,
            1 - len(line_counts) / len(lines),
            max(line_counts.values()) * len(max(line_counts, key=line_counts.get)) / size
            if len(lines) > 1
            else 0.0,
            sum(w[-1:].isalnum() or w[-1] > 127 for w in words) / n,
        ]
    )
    plain = [np.log1p(len(raw)) / 10, np.log1p(len(words)) / 10, size / n / 10, len(lines) / n]
    return np.concatenate([plain, shares, np.sqrt(shares), shares > 0])


def features(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """One row per document: the id, ``_x`` and the columns to keep."""
    names = list(dict.fromkeys([id_col, *keep]))
    source = docs.select(
        *[F.col(f"`{c}`").alias(f"_keep_{c}") for c in names], F.col(f"`{text_col}`").alias("_text")
    )
    kept = [f for f in source.schema if f.name != "_text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", _x array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [text_features(t.as_py()).astype(np.float32) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(x, pa.list_(pa.float32()))],
                names=[*(f.name for f in kept), "_x"],
            )

    return source.mapInArrow(run, schema)


def preference_pairs(rows: DataFrame) -> DataFrame:
    """x (feature difference, vector) and label of pairs of a preferred and a rejected row.

    ``rows`` (good, x) is the bounded sample. Every row of the larger class meets
    ``PARTNERS`` of the other, by rank; every second pair is turned round.
    """
    order = Window.partitionBy("good").orderBy(F.xxhash64("id"), "id")
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1)
    sizes = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count("*").alias("n")).collect()}
    few, many = sorted((False, True), key=lambda good: sizes[good])
    partner = F.pmod(F.col("rank") * PARTNERS + F.col("turn"), F.lit(sizes[few]))
    larger = ranked.filter(F.col("good") == many).select(
        F.col("x").alias("a"), "rank", F.explode(F.array(*map(F.lit, range(PARTNERS)))).alias("turn")
    )
    smaller = ranked.filter(F.col("good") == few).select(F.col("x").alias("b"), F.col("rank").alias("partner"))
    sign = F.when(F.col("rank") % 2 == 0, 1.0).otherwise(-1.0)
    pairs = larger.withColumn("partner", partner).join(smaller, "partner")
    difference = F.zip_with("a", "b", lambda a, b: ((a - b) * sign).cast("double"))
    better = F.lit(many) == (F.col("rank") % 2 == 0)
    return pairs.select(array_to_vector(difference).alias("x"), better.cast("double").alias("label"))


def learn(rows: DataFrame):
    """The ranking, or None if there is nothing to prefer."""
    if rows.select("good").distinct().count() < 2:
        return None
    pairs = materialize(preference_pairs(rows), "preferences")
    return LogisticRegression(
        featuresCol="x", labelCol="label", fitIntercept=False, regParam=REGULARISATION, maxIter=100
    ).fit(pairs)


def cut_of(scored: DataFrame) -> float | None:
    """The score that cuts off as many of the rows (s, good) as are not good, to one in
    ``ACCURACY`` of their number."""
    n, bad = scored.agg(F.count("*"), F.count_if(~F.col("good"))).first()
    place = min(1.0, (bad + 0.5) / max(n, 1))
    return scored.agg(F.percentile_approx("s", F.lit(place), F.lit(ACCURACY))).first()[0]


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    *,
    held_parts: int = 3,
    held_part: int = 1,
    keep: list[str] | None = None,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Score whole texts, learning from labels whose id is not in the held-out part.

    One row per input row: the id (and the columns of ``keep``), held_out, score (0 to 1,
    0.5 at the cut), predicted. Labels of a NULL id or value teach nothing, repeated labels
    count each; without labels of both kinds every score is 0.5 and nothing is rejected.
    NULL and empty texts are scored as texts of no words; an empty table gives no rows;
    other columns are ignored. The ranking is learned from ``max_labelled`` rows at most,
    in expectation, whose ids are sent to the documents. The cut is taken from the scores of
    all labelled documents outside the held-out part: every text is scored once, where it is
    read, and its row is written with the score.
    """
    known = labels.select(
        F.col(f"`{label_id_col}`").alias("id"), F.col(f"`{label_col}`").alias("value")
    ).filter("id IS NOT NULL AND value IS NOT NULL")
    every = known.filter(in_other_part("id", held_parts, held_part))
    every = materialize(every.select("id", (F.col("value") > 0).alias("good")), "known")
    share, known = max_labelled / max(every.count(), 1), every
    if share < 1:
        known = every.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = F.broadcast(known.select(F.col("id").alias(id_col)).distinct())
    asked = docs.select(id_col, text_col).join(sample, id_col, "left_semi")
    taught = materialize(
        features(asked, id_col, text_col, [])
        .select(F.col(f"`_keep_{id_col}`").alias("id"), F.col("_x").alias("x"))
        .join(known, "id")
        .select("id", "x", "good"),
        "labelled",
    )
    model = learn(taught)
    found = features(docs, id_col, text_col, keep or [])
    kept = [c for c in found.columns if c.startswith("_keep_")]
    score = F.lit(0.5)
    if model:
        found = model.transform(found.withColumn("x", array_to_vector(F.col("_x").cast("array<double>"))))
        found = materialize(found.select(*kept, vector_to_array("rawPrediction")[1].alias("s")), "scored")
        judged = found.select(F.col(f"_keep_{id_col}").alias("id"), "s").join(every, "id")
        score = 1 / (1 + F.exp(F.lit(cut_of(judged)) - F.col("s")))
    held = F.coalesce(id_part(f"_keep_{id_col}", held_parts) == held_part, F.lit(False))
    return found.select(
        *[F.col(c).alias(c.removeprefix("_keep_")) for c in kept], held.alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
