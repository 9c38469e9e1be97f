"""Near-duplicates, decontamination, quality."""

import itertools
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from contentloom.llm import decontamination, near_dedup, quality
from contentloom.llm.decontamination import decontaminate, drop_contaminated
from contentloom.llm.near_dedup import components, keep_one_each, near_duplicates, shingle_set, signature
from contentloom.llm.quality import score_quality


def check(df, rows, percent):
    want = brute.near_duplicates(rows, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, percent=percent).collect()}
    assert got == want


def variants(n, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(220)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((rng.randrange(10**9), " ".join(w)))
    return list(dict(rows).items())


def test_links_are_whole(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    check(documents, rows, 85)


@pytest.mark.parametrize("cell", [512, 7])
def test_groups_of_variants(spark, monkeypatch, cell):
    monkeypatch.setattr(near_dedup, "CELL", cell)
    rows = variants(40, 1) + variants(25, 2)
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 80)


def test_circulant_signature_estimates_similarity():
    a = shingle_set(" ".join(f"t{i}" for i in range(1000)))
    b = shingle_set(" ".join(f"t{i}" for i in range(200, 1200)))
    same = (signature(a, 252) == signature(b, 252)).mean()
    assert abs(same - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.12


def test_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.id: r.label for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_odd_rows_dedup(odd, empty):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd, percent=80).collect()}
    assert {(1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (None, 3, None, True)} <= got
    assert {(9, 1, 9, True), (10, 1, 9, False), (8, 978, 7, False)} <= {(a, b, c, d) for a, b, c, d in got}
    kept = keep_one_each(odd, percent=80)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.select("doc_id").collect()) == [0, 1, 3, 4, 5, 7, 9, 11]
    assert near_duplicates(empty).count() == 0 and keep_one_each(empty).count() == 0


def test_texts_of_one_id_are_documents_each(spark):
    """Neither text of an id goes as a copy of the other's group; copies of a row go."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a, 1), (5, b, 2), (9, b, 3), (5, a, 4), (7, c, 5), (None, a, 6), (None, a, 7), (11, "", 8), (11, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own int").repartition(3)
    kept = keep_one_each(docs, percent=80)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert len(got) == 6 and [t for _, t in got].count(a) == 3 and [t for _, t in got].count(b) == 1
    assert {i for i, t in got if t == ""} == {11} and (7, c) in got


def test_other_ids_are_refused(spark):
    docs = spark.createDataFrame([("a", "x y z")], "doc_id string, text string")
    for run in (near_duplicates, keep_one_each):
        with pytest.raises(TypeError, match="whole number"):
            run(docs)


def decontaminated(docs, items):
    return [tuple(r) for r in decontaminate(docs, items).select("n_words", "n_hit", "n_items", "items_sha256").collect()]


def test_contamination(spark, documents, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute.contamination(rows, [(r.item_id, r.text) for r in items.collect()])
    assert sorted(decontaminated(documents, items)) == sorted(want)


def test_contamination_odd(spark, odd, odd_rows, empty):
    words = [f"q{i}" for i in range(30)]
    items = [
        (1, "Gamma, delta epsilon"), (2, "one"), (3, ""), (4, None), (None, "one two"), (5, "gamma delta epsilon"),
        (6, " ".join(words)), (6, " ".join(words)), (7, "the the the the the the the the the the the the"), (8, "word0 word1 absent"),
    ]
    extra = [
        (20, " ".join(words[3:15]) + " ! " + " ".join(words[20:30])), (21, "THE " * 14), (22, "x " + " ".join(words[:9])),
        (23, " ".join([*words[:5], "zz", *words[6:12]])),
    ]
    rows = [(r[0], r[1]) for r in odd_rows] + extra
    docs = odd.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, words int")
    assert sorted(decontaminated(docs, bench)) == sorted(brute.contamination(rows, items))
    near = {r.doc_id: r.n_near for r in decontaminate(docs, bench).collect()}
    assert near[23] == 1 and near[20] == 0
    assert decontaminate(empty, bench).count() == 0
    assert {r[1] for r in decontaminated(docs, bench.limit(0))} == {0}


def test_contamination_in_portions(spark, monkeypatch, documents, sf_dir):
    """Many portions of the benchmark, small chunks of documents and candidates."""
    for name, value in {"CHUNK_WORDS": 500, "CANDIDATES": 50, "MEMO": 20}.items():
        monkeypatch.setattr(decontamination, name, value)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute.contamination(rows, [(r.item_id, r.text) for r in items.collect()])
    got = decontaminate(documents, items, portion_words=400).select("n_words", "n_hit", "n_items", "items_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_a_run_that_all_documents_and_items_share(spark):
    """Candidates come from the rarest words of a window, not from what is everywhere."""
    rng = random.Random(4)
    new = lambda: " ".join(f"r{rng.randrange(10**9)}" for _ in range(4))
    text = lambda n: " ".join(f"one of the {new()}" for _ in range(n))
    rows, items = [(i, text(160)) for i in range(160)], [(i, text(160)) for i in range(160)]
    rows.append((160, "x " + " ".join(items[3][1].split()[8:40])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    hashed = [decontamination.word_hashes(decontamination.words_of(t)) for _, t in items]
    texts, _ = decontamination.benchmark_texts(bench, "item_id", "text")
    terms = texts.select(F.explode("hashes").alias("term")).distinct()
    index = decontamination.build_index(docs, "text", ["doc_id"], decontamination.hash_filter(terms, "term"))
    frequency = {r.term: r.n for r in decontamination.term_frequencies(index).collect()}
    plan = decontamination.plan_windows(list(enumerate(hashed)), frequency, 10, 8)
    first = plan["probes"][0]
    looked_at = sum(n * int(first[c + 1] - first[c]) for c, t in enumerate(plan["vocabulary"].tolist(), 1) for n in [frequency.get(t, 0)])
    assert looked_at < 10 * 160 * 160
    got = {r.doc_id: (r.n_hit, r.n_items, r.n_near) for r in decontaminate(docs, bench).collect()}
    assert got[160] == (32, 1, 0) and all(v == (0, 0, 0) for i, v in got.items() if i < 160)


def test_drop_contaminated(spark, odd):
    bench = spark.createDataFrame([("i", "alpha beta gamma delta epsilon zeta eta"), ("j", "nowhere to be found")], "item_id string, text string")
    kept = drop_contaminated(odd, bench)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7, 8, 9, 10, 11]
    same_id = spark.createDataFrame([(1, "nowhere to be found"), (1, "another text"), (1, "another text")], "doc_id long, text string")
    assert [r.text for r in drop_contaminated(same_id, bench).collect()] == ["another text"] * 2


def near_items(text, items, window=10, near=8):
    """Number of items with a near window and no whole one, by comparing at every place."""
    words, found = text.split(), 0
    for item in {tuple(t.split()) for t in items}:
        k = min(window, len(item))
        same = [
            sum(a == b for a, b in zip(words[i : i + k], item[j : j + k], strict=True))
            for i in range(len(words) - k + 1)
            for j in range(len(item) - k + 1)
        ]
        found += max(same, default=0) >= min(near, k) and max(same) < k
    return found


def test_near_matches_are_whole(spark):
    """Every one- and two-word substitution, some of three, by words that occur or not."""
    ten, nine, eight = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("t", 10), ("n", 9), ("e", 8)))
    long = " ".join(f"l{i}" for i in range(14))
    items = [ten, nine, eight, long, "two words", "one", ten + " lost", "same " * 12]
    texts = []
    for item in (ten, nine, eight, long):
        words = item.split()
        places = [set(p) for n in (1, 2, 3) for p in itertools.combinations(range(len(words)), n)]
        for k, at in enumerate(places if item != long else places[::3]):
            new = "l3" if k % 2 else f"new{k}"
            texts.append("a b " + " ".join(new if i in at else w for i, w in enumerate(words)) + " c")
    texts += [ten, long, "x two words", "two", "same " * 9 + "other same same", "n1 n2 n3 n4 n5 n6 n7 n8 c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: r.n_near for r in decontaminate(docs, bench).collect()}
    assert got == {i: near_items(t, items) for i, t in enumerate(texts)}
    assert sum(n > 0 for n in got.values()) > 100


def test_quality_held_out(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = score_quality(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").toPandas()
    held = scored[scored.held_out]
    assert (held.predicted == held.quality).mean() > 0.97
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.99
    assert scored.score.between(0, 1).all() and set(scored.held_out) == {True, False}


def test_quality_equals_a_plain_fit(spark):
    """Pairs, ranking, cut and scores against plain numpy on the same labelled rows."""
    rng = random.Random(2)
    good = ["The %s walked to the %s and said a few words." % (rng.choice("abcdefgh") * 3, rng.choice("xyz") * 4) for _ in range(40)]
    bad = ["%s !!! BUY $$$ %s" % (rng.randrange(999), "now " * rng.randrange(1, 9)) for _ in range(25)]
    odd = ["BUY a house, said the man.", "The the the !!! walked."] * 4
    texts = good + bad + odd
    marks = [1] * 40 + [0] * 25 + [1, 0] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id long, quality int")
    got = {r.doc_id: r for r in score_quality(docs, labels).collect()}

    taught = [i for i in range(len(texts)) if brute.part(i, 3) != 1]
    x = np.array([quality.text_features(t).astype(np.float32) for t in texts], float)
    rows = spark.createDataFrame([(i, x[i].tolist(), bool(marks[i])) for i in taught], "id long, x array<double>, good boolean")
    pairs = quality.preference_pairs(rows).collect()
    larger = max(sum(marks[i] == m for i in taught) for m in (0, 1))
    assert len(pairs) == quality.PARTNERS * larger
    d = np.array([p.x.toArray() for p in pairs])
    sign = np.array([2 * p.label - 1 for p in pairs])
    ways = {tuple(np.round(x[i] - x[j], 5)) for i in taught for j in taught if marks[i] > marks[j]}
    assert all(tuple(np.round(s * v, 5)) in ways for s, v in zip(sign, d))

    std = d.std(axis=0, ddof=1)
    use = std > 0
    z = d[:, use] / std[use]
    w = np.zeros(z.shape[1])
    for _ in range(60):  # Newton steps on the mean logistic loss
        p = 1 / (1 + np.exp(sign * (z @ w)))
        gradient = -(z * (sign * p)[:, None]).mean(axis=0) + quality.REGULARISATION * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(z) + quality.REGULARISATION * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    s = x[:, use] @ (w / std[use])
    at = sorted(s[i] for i in taught)
    n_bad = sum(marks[i] == 0 for i in taught)
    cut = at[n_bad]
    plain = 1 / (1 + np.exp(np.clip(cut - s, -50, 50)))
    ours = np.array([got[i].score for i in range(len(texts))])
    assert sum(got[i].predicted == 0 for i in taught) == sum(s[i] < cut for i in taught)
    clear = np.abs(s - cut) > 1
    assert ((ours >= 0.5) == (plain >= 0.5))[clear].all() and clear.mean() > 0.8


def test_quality_cut_covers_all_labels(spark):
    """With a sample of 300 labels the rejected share is that of all labels, not the sample's."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("n_chars < 2000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    got = score_quality(docs, labels, max_labelled=300).filter("NOT held_out").join(labels, "doc_id").toPandas()
    assert len(got) > 1000 and (got.predicted == 0).sum() == (got.quality == 0).sum()


def test_quality_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (None, 1), (7, None), (9, 1), (3, 0)], "doc_id long, quality int")
    got = score_quality(odd, labels, keep=["text", "label"])
    assert got.count() == odd.count() and got.filter(F.col("score").isNull() | F.isnan("score")).count() == 0
    assert score_quality(empty, labels).count() == 0
    same = score_quality(odd, labels.limit(0)).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in same] == [(0.5, 1)]
