"""Packing, top-k search, revisits, entry point, pipeline."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from contentloom.llm import oracles, queries, topk
from contentloom.llm.packing import pack_documents, plan_best_fit
from contentloom.llm.revisits import canonical_url, captures_of, latest_earlier, merge_headers, resolve_revisits
from contentloom.llm.topk import search_bucket, top_k


def packed_well(rows, texts, capacity=2048):
    """Every text whole and in order, every sequence gapless."""
    tokenizer = Tokenizer.from_file(queries.tokenizer_files()["tokenizer_path"])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == capacity for r in own[1:]) and sum(r.length for r in own) == len(ids)
        for r in own:
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark, documents):
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    got = pack_documents(documents, **queries.tokenizer_files()).collect()
    used = packed_well(got, texts)
    assert used <= 1.01 * -(-sum(r.length for r in got) // 2048) + 1


def test_packing_odd(spark, odd, empty):
    extra = [(30, "tab\tand  spaces\x1c\x85 <|endoftext|> x"), (31, "日本語 текст 🙂 é  \n\n  end "), (32, "a  b\t c\t\n d")]
    texts = [(1, "Alpha beta"), (3, None), (4, ""), *extra]
    docs = spark.createDataFrame([(*t, 1, "x") for t in texts], "doc_id long, text string, length int, block string")
    packed_well(pack_documents(docs, **queries.tokenizer_files()).collect(), texts)
    assert pack_documents(odd, **queries.tokenizer_files()).filter("piece = 0").count() == odd.count()
    assert pack_documents(empty, **queries.tokenizer_files()).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_gives_every_rank_a_slot(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 100): rng.randint(0, 400) for _ in range(40)}
    slots = plan_best_fit(counts, 100)
    room = defaultdict(list)
    for length, low, high, first, per, used in slots:
        for rank in range(low, high):
            room[first + (rank - low) // per].append((used + (rank - low) % per * length, length))
    for placed in room.values():
        ends = 0
        for offset, length in sorted(placed):
            assert offset == ends
            ends += length
        assert ends <= 100
    ranks = defaultdict(list)
    for length, low, high, *_ in slots:
        ranks[length] += range(low, high)
    assert all(sorted(ranks[k]) == list(range(n)) for k, n in counts.items() if n)
    assert len(room) <= 1.25 * sum(k * n for k, n in counts.items()) / 100 + 1


def test_top_k_matches_sql(spark, sf_dir, sql):
    sql(queries.op8_topk(spark, sf_dir), oracles.OP8)


def plain_top_k(rows, k, scale=64):
    fit = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(fit):
        if i is not None and i % 20 == 0:
            scored = [(-sum(a * b for a, b in zip(q, c)), j is None, j or 0) for m, (j, c) in enumerate(fit) if m != n]
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("part", [4096, 9])
def test_top_k_ties_and_odd_vectors(spark, monkeypatch, part):
    monkeypatch.setattr(topk, "PART_ROWS", part)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * rng.choice([0.1, 1, 5])).tolist()) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(20, rows[20][1]), (None, rows[7][1])]
    rows += [(160, None), (180, [1.0, None]), (200, [float("nan")] * 6), (220, [float("inf")] * 6), (240, []), (260, [3.0, -2.0])]
    table = spark.createDataFrame([(*r, 0, 0.0) for r in rows], "vec_id long, embedding array<double>, row int, norm double")
    got = sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in top_k(table, k=7).collect()), key=str)
    assert got == plain_top_k(rows, 7)
    assert top_k(table.limit(0)).count() == 0


def test_floor_of_tiny_and_huge_components(spark):
    """A tiny negative component is floored to -1, not rounded to 0; whole numbers stay."""
    rows = [(0, [1.0, 1.0]), (1, [-1e-20, 0.5]), (2, [0.0, 0.484375]), (3, [-0.0, 1e-300]), (20, [2.0**24, -1e-17])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in top_k(table, k=4).collect()), key=str)
    assert got == plain_top_k(rows, 4)
    assert (0, 2, 1, 1984) in got and (0, 3, 2, 1984) in got


def test_both_prunings_are_exact():
    import pandas as pd

    rng = np.random.default_rng(2)
    c = np.floor(rng.normal(size=(500, 8)) * 64)
    q = np.floor(np.eye(8)[[0, 3, 5]] * 90 + rng.normal(size=(3, 8)) * 4)
    bucket = pd.DataFrame({"row": range(500), "vec_id": range(500), "v": list(c), "norm": np.linalg.norm(c, axis=1)})
    for theta in (None, 12_000, 16_000, 40_000):
        queries_ = pd.DataFrame({"row": [900, 901, 902], "v": list(q), "norm": np.linalg.norm(q, axis=1), "theta": [theta] * 3})
        got = search_bucket(queries_, bucket, 5)
        for i in range(3):
            scores = c @ q[i]
            best = sorted(zip(-scores, range(500)))[:5]
            want = [(j, -s) for s, j in best if theta is None or -s >= theta]
            have = got[got["query"] == 900 + i]
            assert sorted(zip(have.row, have.score)) == sorted(want)


def test_revisits_match_sql(spark, sf_dir, sql):
    sql(queries.op5_revisits(spark, sf_dir), oracles.OP5)


RECORDS = "record_id long, url string, time long, type string, etag string, last_modified string, digest string, headers array<struct<name:string,value:string>>, rank int"


def test_revisits_cases(spark):
    h = [("Date", "d0"), ("Content-Length", "9"), ("etag", "old")]
    rows = [
        (1, "http://A.com:80/x?b=2&a=1&utm_q=3#f", 10, "response", '"v1"', None, "s", h, 0),
        (2, "https://www.a.com/x?a=1&b=2", 20, "response", '"v2"', "m", None, h, 0),
        (3, "http://a.com/x?a=1&b=2", 20, "revisit", 'W/"v1"', None, None, [("DATE", "d1"), ("Content-Length", "0"), ("ETag", "new"), (None, "n")], 0),
        (4, "http://a.com/x?b=2&a=1", 30, "revisit", '"v1"', "m", None, None, 0),
        (5, "http://a.com/x?b=2&a=1", 5, "revisit", '"v1"', None, None, None, 0),
        (6, "http://b.com", 9, "revisit", None, None, None, None, 0),
        (7, None, 9, "revisit", None, None, None, None, 0),
        (8, "http://a.com/x?b=2&a=1", None, "revisit", None, None, None, None, 0),
        (9, "http://a.com/x?b=2&a=1", 25, "revisit", None, None, None, [], 0),
        (9, "http://a.com/x?b=2&a=1", 25, "revisit", None, None, None, [], 0),
        (10, "http://a.com/x?a=1&b=2", 40, "metadata", None, None, None, None, 0),
    ]
    got = sorted((r.record_id, r.status, r.response_id) for r in resolve_revisits(spark.createDataFrame(rows, RECORDS)).collect())
    assert got == [
        (3, "resolved", 1), (4, "mismatch", 2), (5, "missing", None), (6, "missing", None), (7, "missing", None),
        (8, "missing", None), (9, "unchecked", 2), (9, "unchecked", 2),
    ]
    merged = {r.record_id: r.headers for r in resolve_revisits(spark.createDataFrame(rows, RECORDS)).collect()}[3]
    assert [(x.name, x.value) for x in merged] == [("Content-Length", "9"), ("DATE", "d1"), ("ETag", "new")]
    assert resolve_revisits(spark.createDataFrame([], RECORDS)).count() == 0


@pytest.mark.parametrize("buckets", [1, 7, 50])
def test_latest_earlier_over_stretches(spark, buckets):
    rng = random.Random(buckets)
    rows = [(rng.choice("aab"), t, rng.choice([None, t])) for t in rng.sample(range(1000), 120)]
    points = spark.createDataFrame(rows, "url string, time long, response long")
    want = {(u, t): max((x for v, x, r in rows if v == u and x < t and r is not None), default=None) for u, t, _ in rows}
    assert {(r.url, r.time): r.found for r in latest_earlier(points, buckets).collect()} == want


def test_pipeline_stages(spark, sf_dir, documents):
    docs, kept = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}-{random.random()}"
        after.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs.count())
    assert documents.count() > kept[0] > kept[1] > kept[2] == kept[3] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    packed_well(packed, [(r.doc_id, r.text) for r in docs.collect()])
    assert not docs.filter(F.col("text").rlike("AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}")).count()


def test_pipeline_odd_rows(spark, sf_dir, odd, empty):
    for table in (odd, empty):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == table.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).filter("piece = 0").count() == docs.count()


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
