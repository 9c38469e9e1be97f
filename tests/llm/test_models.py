"""Language identification and language model."""

import brute
import numpy as np
import pytest

from contentloom.llm import language_id
from contentloom.llm.language_id import Labeller, forward_backward, identify_languages, learn
from contentloom.llm.language_model import score_texts


def brute_posterior(scores, transitions):
    """All label sequences, one by one."""
    t, n = scores.shape
    out = np.zeros((t, n))
    for code in range(n**t):
        path = [code // n**i % n for i in range(t)]
        w = np.exp(
            sum(scores[i, y] for i, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:]))
        )
        for i, y in enumerate(path):
            out[i, y] += w
    return out / out.sum(axis=1, keepdims=True)


def test_forward_backward_is_exact(monkeypatch):
    monkeypatch.setattr(language_id, "BLOCK", 3)
    rng = np.random.default_rng(0)
    sizes = np.array([7, 1, 3, 4, 8])
    scores, transitions = rng.normal(size=(sizes.sum(), 3)) * 2, rng.normal(size=(3, 3))
    got = forward_backward(scores, sizes, transitions)
    at = 0
    for n in sizes:
        assert np.allclose(got[at : at + n], brute_posterior(scores[at : at + n], transitions))
        at += n


def test_long_texts_stay_finite():
    scores = np.tile([[9.0, -9.0]], (50_000, 1))
    got = forward_backward(scores, np.array([50_000]), np.array([[3.0, -3.0], [-3.0, 3.0]]))
    assert np.isfinite(got).all() and got[:, 0].min() > 0.99


def test_languages_held_out(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == docs.count() and (held.lang == held.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()
    assert set(held.doc_id) == {i for i in got.doc_id if brute.part(i, 4) == 2}


def test_code_switched_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang IN ('de', 'en')")
    field = learn(docs.selectExpr("lang", "text", "cast(doc_id % 4 as int) AS shard").limit(200))
    words = "the thing with this under der und nicht werden ich from these".split()
    truth = ["en"] * 5 + ["de"] * 5 + ["en"] * 2
    posterior = Labeller(field).posteriors([words])
    got = [field["languages"][i] for i in posterior.argmax(axis=1)]
    assert sum(a == b for a, b in zip(got, truth)) >= 10
    assert got[0] == "en" and got[6] == "de"


@pytest.mark.parametrize("score", [identify_languages, score_texts])
def test_models_odd_rows(odd, empty, score):
    got = score(odd).collect()
    assert len(got) == odd.count() and score(empty).count() == 0
    assert all(r.held_out is False for r in got if r.doc_id is None)


def test_texts_without_letters(odd):
    got = {r.doc_id: r for r in identify_languages(odd).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (3, 4, 5, 11))
    assert got[7].lang_pred == "en" and got[7].n_words == 30_000


def test_rare_languages_are_learned(spark):
    """Three documents of 3,003 (less than 0.2 %) and their copies elsewhere get their language."""
    common = [(i, f"the house and garden number {'abcdefghij'[i % 10]} near some river", "en") for i in range(3000)]
    held = [i for i in range(4000, 4100) if brute.part(i, 4) == 2][:2]
    rare = [i for i in range(4000, 4100) if brute.part(i, 4) != 2][:3]
    rows = common + [(i, "zwykly dom oraz ogrod przy rzece wsrod drzew " * 3, "pl") for i in rare + held]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in identify_languages(docs).filter("doc_id >= 4000 OR doc_id < 5").collect()}
    assert got == {**dict.fromkeys(range(5), "en"), **dict.fromkeys(rare + held, "pl")}


def test_dirty_language_column_is_refused(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'some text' AS text", "concat('x', id) AS lang")
    with pytest.raises(ValueError, match="languages"):
        identify_languages(docs)


def test_pair_counts_are_exact(monkeypatch):
    monkeypatch.setattr(language_id, "BLOCK", 3)
    rng = np.random.default_rng(1)
    scores, t = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    want, total = np.zeros((3, 3)), 0.0
    for path in np.ndindex(*[3] * 5):
        w = np.exp(sum(scores[i, y] for i, y in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
        total += w
        for a, b in zip(path, path[1:]):
            want[a, b] += w
    assert np.allclose(forward_backward(scores, np.array([5]), t, edges=True)[1], want / total)


def same_model(df, rows):
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in score_texts(df).collect())
    for ours, theirs in zip(got, sorted(brute.language_model(rows)), strict=True):
        assert ours[:3] == theirs[:3]
        assert ours[3:] == pytest.approx(theirs[3:], rel=1e-9)


def test_language_model(spark, documents, monkeypatch):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    same_model(documents, rows)


def test_language_model_odd(odd, odd_rows):
    same_model(odd, [(r[0], r[1]) for r in odd_rows])


def test_interpolation_beats_unigrams(documents):
    got = score_texts(documents).filter("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()
    assert set(got.doc_id) == {r.doc_id for r in documents.collect() if brute.part(r.doc_id, 7) == 2}
