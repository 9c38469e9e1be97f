"""Language of every word, and so of every text, by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from contentloom.functions.language import MAX_LANGUAGES
from contentloom.llm.common import in_other_part, is_part, materialize, slim

#: Documents per language that the field is learned from, about, chosen by their id's hash.
DOCS_PER_LANGUAGE = 300
UNKNOWN = "und"
HASH_BITS = 16
#: Shards that learn apart before their weights are averaged, and how often.
SHARDS, MIXINGS, EPOCHS = 6, 2, 3
SEQUENCE, BATCH = 48, 128
RATE, DECAY = 0.25, 1e-6
#: Rows of the weights that are averaged at a time.
FEATURES_AT_ONCE = 4096
LEXICON_SEEN, LEXICON_SHARE = 3, 0.95
BLOCK = 32
#: Words whose scores a worker keeps, and documents that it labels at a time.
CACHED_WORDS, DOCS_AT_ONCE = 200_000, 500
#: Numbers in the transfer matrices of the documents that are labelled at a time.
CELLS_AT_ONCE = 20_000_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    found = _WORD.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()


def word_features(word: str, lexicon: dict[str, int]) -> list[int]:
    """The word itself, affixes of up to three letters, inner bi- and trigrams as hashes, and
    the language whose lexicon has it."""
    mask = (1 << HASH_BITS) - 1
    raw = f"^{word}$"
    keys = [raw, *(f"<{word[:k]}" for k in (1, 2, 3)), *(f">{word[-k:]}" for k in (1, 2, 3))]
    keys += [raw[i : i + n] for n in (2, 3) for i in range(len(raw) - n + 1)]
    found = [crc32(k.encode()) & mask for k in keys]
    if word in lexicon:
        found.append(mask + 1 + lexicon[word])
    return found


def word_scores(words: list[str], weights: np.ndarray, lexicon: dict[str, int]) -> np.ndarray:
    flat, starts = _flat_features(words, lexicon)
    return np.add.reduceat(weights[flat], starts, axis=0)


def _flat_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    each = [word_features(w, lexicon) for w in words]
    sizes = np.array([len(f) for f in each])
    return np.fromiter((i for f in each for i in f), np.int64, sizes.sum()), np.cumsum(sizes) - sizes


def forward_backward(
    scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, edges: bool = False
) -> np.ndarray | tuple:
    """Posteriors of every word's labels in sequences of the given sizes.

    Sequences are cut into blocks whose transfer matrices are multiplied up side by side;
    only the blocks of one sequence are then chained, so a very long text takes no more
    passes over the batch than its number of blocks. With ``edges`` also the expected
    number of every label pair.
    """
    labels = scores.shape[1]
    step = np.exp(transitions)
    blocks = -(-sizes // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    place = np.arange(len(scores)) + np.repeat(first_block * BLOCK - (np.cumsum(sizes) - sizes), sizes)
    psi = np.ones((total * BLOCK, labels))
    psi[place] = np.exp(scores - scores.max(axis=1, keepdims=True))
    psi = psi.reshape(total, BLOCK, labels)
    still = np.ones(total * BLOCK, bool)  # positions without a transition: beginnings, padding
    still[place] = False
    still[first_block * BLOCK] = True
    still = still.reshape(total, BLOCK, 1)

    def norm(x: np.ndarray, axes) -> np.ndarray:
        return x / x.max(axis=axes, keepdims=True)

    transfer = np.broadcast_to(np.eye(labels), (total, labels, labels))
    for t in range(BLOCK):
        moved = np.where(still[:, t, :, None], transfer, transfer @ step)
        transfer = norm(moved * psi[:, t, None, :], (1, 2))
    begin, end = np.ones((total, labels)), np.ones((total, labels))
    order = np.argsort(-blocks, kind="stable")
    live = np.searchsorted(-blocks[order], -np.arange(1, blocks.max() + 1), side="right")
    a = np.ones((len(sizes), labels))
    for k, n in enumerate(live):
        at = first_block[order[:n]] + k
        begin[at] = a[:n]
        a[:n] = norm(np.einsum("ni,nij->nj", a[:n], transfer[at]), 1)
    b = np.ones((len(sizes), labels))
    for k in range(len(live) - 1, -1, -1):
        n = live[k]
        at = first_block[order[:n]] + k
        end[at] = b[:n]
        b[:n] = norm(np.einsum("nij,nj->ni", transfer[at], b[:n]), 1)
    forward, backward = np.empty_like(psi), np.empty_like(psi)
    for t in range(BLOCK):
        begin = norm(np.where(still[:, t], begin, begin @ step) * psi[:, t], 1)
        forward[:, t] = begin
    for t in range(BLOCK - 1, -1, -1):
        backward[:, t] = end
        down = end * psi[:, t]
        end = norm(np.where(still[:, t], down, down @ step.T), 1)
    both = forward * backward
    posterior = (both / both.sum(axis=2, keepdims=True)).reshape(-1, labels)[place]
    if not edges:
        return posterior
    f, g = forward.reshape(-1, labels)[place], (backward * psi).reshape(-1, labels)[place]
    inner = np.flatnonzero(~still.reshape(-1)[place])
    f, g = f[inner - 1], g[inner]
    f = f / ((f @ step) * g).sum(axis=1, keepdims=True)
    return posterior, step * (f.T @ g)


def _learn_shard(rows: pd.DataFrame, languages: list[str], lexicon: dict, weights, transitions):
    """AdaGrad on the likelihood of code-switched sequences.

    Segments of the shard's texts are dealt at random and strung together, so that the
    transitions are learned from changes of language, too.
    """
    rng = np.random.default_rng(int(rows["shard"].iloc[0]))
    label_of = {lang: i for i, lang in enumerate(languages)}
    vocabulary: dict[str, int] = {}
    segments = []
    for text, lang in zip(rows["text"], rows["lang"], strict=True):
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)]
        at = 0
        while at < len(ids):
            size = int(rng.integers(3, SEQUENCE))
            segments.append((np.array(ids[at : at + size]), label_of[lang]))
            at += size
    if not segments:
        return weights, transitions
    flat, starts = _flat_features(list(vocabulary), lexicon)
    widths = np.diff(starts, append=len(flat))
    seen, seen_steps = np.full(weights.shape, 1e-2), np.full(transitions.shape, 1.0)
    n = len(languages)
    for _ in range(EPOCHS):
        dealt = rng.permutation(len(segments))
        words = np.concatenate([segments[i][0] for i in dealt])
        truth = np.repeat([segments[i][1] for i in dealt], [len(segments[i][0]) for i in dealt])
        for at in range(0, len(words), BATCH * SEQUENCE):
            kinds, back = np.unique(words[at : at + BATCH * SEQUENCE], return_inverse=True)
            own = np.concatenate([flat[starts[k] : starts[k] + widths[k]] for k in kinds])
            cuts = np.cumsum(widths[kinds]) - widths[kinds]
            scores = np.add.reduceat(weights[own], cuts, axis=0)[back]
            y = truth[at : at + len(back)]
            sizes = np.full(-(-len(back) // SEQUENCE), SEQUENCE)
            sizes[-1] = len(back) - SEQUENCE * (len(sizes) - 1)
            posterior, joint = forward_backward(scores, sizes, transitions, edges=True)
            error = -posterior
            error[np.arange(len(y)), y] += 1
            by_kind = np.stack([np.bincount(back, error[:, j], len(kinds)) for j in range(n)], 1)
            spread = np.repeat(by_kind, widths[kinds], axis=0)
            gradient = np.stack(
                [np.bincount(own, spread[:, j], len(weights)) for j in range(n)], 1
            ) - DECAY * len(y) * weights
            seen += gradient**2
            weights = weights + RATE * gradient / np.sqrt(seen)
            inner = np.arange(len(y)) % SEQUENCE > 0
            inner = np.flatnonzero(inner)
            true = np.zeros((n, n))
            np.add.at(true, (y[inner - 1], y[inner]), 1)
            g = true - joint - DECAY * len(y) * transitions
            seen_steps += g**2
            transitions = transitions + RATE * g / np.sqrt(seen_steps)
    return weights, transitions


def _shard_learner(*field):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        weights, transitions = _learn_shard(rows, *field)
        cuts = range(0, len(weights), FEATURES_AT_ONCE)
        parts = [*(weights[i : i + FEATURES_AT_ONCE].tobytes() for i in cuts), transitions.tobytes()]
        return pd.DataFrame({"block": range(len(parts)), "shard": rows["shard"].iloc[0], "w": parts})

    return run


def _mean_block(rows: pd.DataFrame) -> pd.DataFrame:
    each = [np.frombuffer(w) for w in rows.sort_values("shard")["w"]]
    return pd.DataFrame({"block": rows["block"].iloc[:1], "w": [np.mean(each, axis=0).tobytes()]})


def learn(taught: DataFrame) -> dict | None:
    """The field from rows of ``lang``, ``text`` and ``shard``; None without any.

    Shards learn side by side and their weights are averaged in blocks, ``MIXINGS`` times. The
    driver sees the lexicon and the mean weights, whose sizes the sample bounds.
    """
    languages = sorted(r[0] for r in taught.select("lang").distinct().collect())
    if not languages:
        return None
    words = taught.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    by_word = words.groupBy("w", "lang").agg(F.count("*").alias("n")).groupBy("w").agg(
        F.max_by("lang", "n").alias("lang"), F.max("n").alias("top"), F.sum("n").alias("n")
    )
    listed = by_word.filter((F.col("n") >= LEXICON_SEEN) & (F.col("top") >= LEXICON_SHARE * F.col("n")))
    lexicon = {r["w"]: languages.index(r["lang"]) for r in listed.collect()}
    weights = np.zeros(((1 << HASH_BITS) + len(languages), len(languages)))
    transitions = np.zeros((len(languages), len(languages)))
    for _ in range(MIXINGS):
        run = _shard_learner(languages, lexicon, weights, transitions)
        learned = taught.groupBy("shard").applyInPandas(run, "block int, shard int, w binary")
        means = learned.groupBy("block").applyInPandas(_mean_block, "block int, w binary").collect()
        *parts, last = [np.frombuffer(r["w"]) for r in sorted(means, key=lambda r: r["block"])]
        weights, transitions = np.concatenate(parts).reshape(weights.shape), last.reshape(transitions.shape)
    return {"languages": languages, "lexicon": lexicon, "weights": weights.astype(np.float32), "transitions": transitions}


class Labeller:
    """Applies a learned field; keeps the scores of the words it meets first."""

    def __init__(self, field: dict):
        self.field = field
        self.place: dict[str, int] = {}
        self.scores = np.empty((0, len(field["languages"])), np.float32)

    def posteriors(self, texts: list[list[str]]) -> np.ndarray:
        """One row of label probabilities per word of all (non-empty) texts."""
        fresh: dict[str, int] = {}
        known, base = self.place, len(self.scores)
        ids = []
        for words in texts:
            for w in words:
                i = known.get(w)
                if i is None:
                    i = base + fresh.setdefault(w, len(fresh))
                ids.append(i)
        scores = self.scores
        if fresh:
            more = word_scores(list(fresh), self.field["weights"], self.field["lexicon"])
            scores = np.concatenate([scores, more])
            if base + len(fresh) <= CACHED_WORDS:
                known.update((w, base + i) for w, i in fresh.items())
                self.scores = scores
        sizes = np.array([len(words) for words in texts])
        return forward_backward(scores[ids].astype(np.float64), sizes, self.field["transitions"])


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    held_parts: int = 4,
    held_part: int = 2,
    docs_per_language: int = DOCS_PER_LANGUAGE,
) -> DataFrame:
    """Label the words of whole texts and sum up.

    One row per input row: id, held_out, lang_pred, score, n_words, n_switches. lang_pred is
    the language with the largest sum of word posteriors, weighted by letters; score is its
    share; n_switches counts changes of the likeliest label from word to word, for
    code-switched text. ``und`` with score 0 where the text is NULL or has no letters, or
    nothing could be learned. Ties go to the first language in order. Rows without id are
    neither held out nor learned from; rows without language teach nothing; repeated rows
    are labelled each; an empty table gives no rows; other columns are ignored. Learned from
    about ``docs_per_language`` whole texts of every language, all texts of one that has no
    more. More languages than any corpus has point to a wrong label column and are refused.
    """
    source = slim(docs, id=id_col, text=text_col, lang=lang_col).withColumn("lang", F.col("lang").cast("string"))
    known = source.filter(
        in_other_part("id", held_parts, held_part) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    found = counts.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is this a language column?")
    rates = {r["lang"]: min(1.0, docs_per_language / r["n"]) for r in found}
    chance = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    chosen = F.lit(False)
    if rates:
        rate = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
        chosen = chance < rate[F.col("lang")]
    taught = materialize(
        known.filter(chosen).select("lang", "text", F.pmod(F.hash("id"), F.lit(SHARDS)).alias("shard")),
        "languages",
    )
    field = learn(taught)
    id_type = source.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, held_out boolean, lang_pred string, score double, n_words long, n_switches long"

    def portions(whole: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
        """Rows and their words, so many that their transfer matrices fit, one at least."""
        each = len(field["languages"]) ** 2 if field else 1
        begin, texts, cells = 0, [], 0
        for text in whole.column("text"):
            words = words_of(text.as_py())
            more = -(-len(words) // BLOCK) * each
            if texts and (len(texts) == DOCS_AT_ONCE or cells + more > CELLS_AT_ONCE):
                yield whole.slice(begin, len(texts)), texts
                begin, texts, cells = begin + len(texts), [], 0
            texts.append(words)
            cells += more
        if texts:
            yield whole.slice(begin, len(texts)), texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(field) if field else None
        for whole in batches:
            for batch, texts in portions(whole):
                n = len(texts)
                pred, score, switches = [UNKNOWN] * n, np.zeros(n), np.zeros(n, np.int64)
                full = [i for i, words in enumerate(texts) if words and labeller]
                if full:
                    posterior = labeller.posteriors([texts[i] for i in full])
                    letters = np.array([len(w) for i in full for w in texts[i]], float)
                    sizes = np.array([len(texts[i]) for i in full])
                    starts = np.cumsum(sizes) - sizes
                    sums = np.add.reduceat(posterior * letters[:, None], starts, axis=0)
                    sums /= sums.sum(axis=1, keepdims=True)
                    best = posterior.argmax(axis=1)
                    changed = np.diff(best, prepend=best[0]) != 0
                    changed[starts] = False
                    score[full] = sums.max(axis=1)
                    switches[full] = np.add.reduceat(changed.astype(np.int64), starts)
                    for i, k in zip(full, sums.argmax(axis=1), strict=True):
                        pred[i] = field["languages"][k]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("held_out"),
                        pa.array(pred, pa.string()),
                        pa.array(score),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array(switches),
                    ],
                    names=["id", "held_out", "lang_pred", "score", "n_words", "n_switches"],
                )

    asked = source.select("id", "text", is_part("id", held_parts, held_part).alias("held_out"))
    return asked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
