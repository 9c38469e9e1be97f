"""Line dedup, ranked search, Merkle manifest."""

import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from contentloom.llm import lexical, merkle, oracles, queries
from contentloom.llm.common import ascii_lower, hash_filter, in_filter, is_part
from contentloom.llm.lexical import rank_documents
from contentloom.llm.line_dedup import kept_text, line_bitmaps
from contentloom.llm.merkle import merkle_manifest

LONG = "This Line is repeated in very many of the documents"


def by_text(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def deduped(docs):
    judged = line_bitmaps(docs, keep=["text"])
    got = judged.select("doc_id", "n_lines", "n_dropped", kept_text(F.col("text"), F.col("bitmap")))
    return [tuple(r) for r in got.collect()]


def test_lines_match_sql(spark, sf_dir, sql):
    sql(queries.op13_line_dedup(spark, sf_dir), oracles.OP13)


def test_lines_of_odd_rows(spark, odd, odd_rows, empty):
    short = "x" * 39
    extra = [(100 + i, f"{LONG}\nown {i}\n \t{LONG.upper()}\r\n{short}\nend") for i in range(6)]
    extra += [(90, LONG), (91, f"{LONG}\n{LONG}"), (92, "é" * 40 + "\na"), (None, LONG + "\n" + LONG), (105, f"a\n{LONG}")]
    extra += [(i, "\x0bÉ" + "é" * 40) for i in range(93, 97)] + [(97, "é" * 41 + "\n\n"), (98, "x\n" * 5000 + LONG)]
    docs = odd.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r[0], r[1]) for r in odd_rows] + extra
    want = brute.lines(rows)
    assert by_text(deduped(docs)) == by_text(want)
    assert sum(r[2] for r in want) > 10
    assert deduped(empty) == []


def test_lines_that_nearly_all_documents_share(spark):
    """One key in every document, cut between documents over many ranges; runs of kept lines."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        lines = [LONG, f"a line that only document number {i} holds, and no other one"]
        lines += [f"passage {rng.randrange(30)} that some of the documents of this test share"] * rng.randrange(1, 4)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert by_text(deduped(docs)) == by_text(brute.lines(rows))
    one = line_bitmaps(docs).filter("doc_id = 399").first()
    assert one.bitmap[0].start == 0 and sum(r.length for r in one.bitmap) == one.n_lines - one.n_dropped


def test_plan_of_line_dedup_is_native(spark, sf_dir):
    plan = queries.op13_line_dedup(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def ranked(docs, items, **options):
    return [tuple(r) for r in rank_documents(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect()]


def test_search_matches_sql(spark, sf_dir, sql):
    sql(queries.op11_lexical_search(spark, sf_dir), oracles.OP11)


@pytest.mark.parametrize("small", [False, True])
def test_search_of_odd_rows(spark, monkeypatch, odd, odd_rows, empty, small):
    """Also with several blocks in a stratum, bins in the index and portions of the items."""
    if small:
        for name, value in {"BLOCK_DOCS": 4, "BIN_DOCS": 16, "QUERY_ITEMS": 2, "SEED_BINS": 3, "MEMO": 8}.items():
            monkeypatch.setattr(lexical, name, value)
    rng = random.Random(5)
    extra = [(100 + i, " ".join(f"t{rng.randrange(25) ** 2 // 20}" for _ in range(rng.choice([3, 8, 8, 8, 40])))) for i in range(150)]
    extra += [(300 + i, "t1 t2 t3 t4, T5!") for i in range(40)] + [(None, "t1 t2 t3 t4 t5")]
    docs = odd.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    items = [
        (1, "T1 t2-t3"), (2, "alpha alpha Beta absent"), (3, None), (4, " .. "), (5, "absent"), (6, "t0 t1 word5 word5"),
        (6, "t0 t1 word5 word5"), (None, "one 12"), (7, " ".join(f"t{i}" for i in range(30))),
    ]
    bench = spark.createDataFrame([(*i, 0.5) for i in items], "item_id long, text string, term double")
    rows = [(r[0], r[1]) for r in odd_rows] + extra
    assert by_text(ranked(docs, bench)) == by_text(brute.ranking(rows, items))
    assert by_text(ranked(docs, bench, k=3)) == by_text(brute.ranking(rows, items, 3))
    assert ranked(empty, bench) == ranked(docs, bench.limit(0)) == []


def test_search_refuses_other_ids(spark, odd):
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    with pytest.raises(TypeError, match="whole number"):
        rank_documents(odd, bench, id_col="source")


def test_pruned_strata_lose_nothing(spark, documents, sf_dir):
    """Thresholds leave few strata to visit, and the result is that of all of them."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute.ranking(rows, [(r.item_id, r.text) for r in items.collect()], 5)
    assert by_text(ranked(documents, items, k=5)) == by_text(want)


def test_hash_filter(spark):
    some = spark.range(1000).select(F.xxhash64("id").alias("h"))
    import numpy as np

    bits = np.frombuffer(hash_filter(some, "h"), np.uint8)
    held = np.array([r.h for r in some.collect()])
    assert in_filter(bits, held).all()
    assert in_filter(bits, held + 1).mean() < 0.01
    assert not in_filter(np.frombuffer(hash_filter(some.limit(0), "h"), np.uint8), held).any()


FIELDS = "doc_id long, text string, lang string, source string, n_chars long, tree int, digest string"


def manifest(docs):
    text = F.col("text")
    now = F.when(is_part("doc_id", 3, 0), ascii_lower(text)).otherwise(text)
    got = merkle_manifest(docs, altered={"text": now}).collect()
    assert all(r.verified == (r.root == r.folded_root) for r in got)
    return [tuple(r)[:-1] for r in got]


def test_manifest_matches_sql(spark, sf_dir, sql):
    sql(queries.op12_merkle_manifest(spark, sf_dir), oracles.OP12)


def test_manifest_of_odd_rows(odd, odd_rows, empty):
    assert by_text(manifest(odd)) == by_text(brute.merkle([r[:5] for r in odd_rows]))
    assert manifest(empty) == []


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [65, 1, 8, 513], [1] * 9, [3] * 20])
def test_shapes_of_trees(spark, monkeypatch, sizes):
    """Lone leaves, full and cut runs, one and many groups, several copies of a node."""
    monkeypatch.setattr(merkle, "CLIMBERS", 3)
    rows, at = [], 0
    for g, n in enumerate(sizes):
        for _ in range(n):
            at += 7
            rows.append((at, f"Text {at}" if at % 5 else None, None if g == 2 else f"g{g}", "s", at, 0, ""))
    docs = spark.createDataFrame(rows, FIELDS).repartition(3)
    want = brute.merkle([r[:5] for r in rows])
    assert by_text(manifest(docs)) == by_text(want)
    if len(rows) > 5:
        assert {w[3] == w[5] for w in want} == {True, False}


def test_manifest_without_changes(documents):
    got = merkle_manifest(documents)
    assert got.filter("NOT verified").count() == 0 and got.count() == documents.count()
    assert got.select("root").distinct().count() == 1
