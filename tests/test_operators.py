"""Keyed, backlog, look-up, term, fuzzy and analytics operators."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from contentloom.operators import analytics, backlog as bl, fuzzy, keyed
from contentloom.operators.lookup import lookup
from contentloom.operators.terms import doc_terms, term_stats, with_idf
from contentloom.plans import analytics_queries
from contentloom.session import scratch_table
from contentloom.sources import blocks as blk


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_and_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 3, "c"), (1, 1, "a"), (1, 2, None), (None, 1, "n"), (None, 0, "m")],
        "k int, o int, v string",
    )
    assert {(r.k, r.v) for r in keyed.first_per_key(df, ["k"], ["o"]).collect()} == {(1, "a"), (None, "m")}
    latest = keyed.latest_per_key(df, ["k"], ["o"])
    assert {(r.k, r.v) for r in latest.collect()} == {(1, "c"), (None, "n")}
    assert rows(keyed.latest_per_key(latest, ["k"], ["o"]).select("v")) == rows(latest.select("v"))


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100_000).select((F.col("id") % 3 * 0).alias("k"), "id")
    plan = keyed.first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") >= 1
    assert "Window" not in plan


def test_survivors_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"), F.md5(F.col("id").cast("string").cast("binary")).alias("o"))
    results = [rows(keyed.first_per_key(df.repartition(n), ["k"], ["o", "id"])) for n in (1, 3, 8)]
    assert results[0] == results[1] == results[2]


def test_top_k_per_key(spark):
    df = spark.createDataFrame([(1, v) for v in (5, 9, 7)] + [(2, 1)], "k int, v int")
    got = rows(keyed.top_k_per_key(df, ["k"], [F.desc("v")], 2))
    assert got == [(1, 7, 2), (1, 9, 1), (2, 1, 1)]


def test_ordinals_are_global_over_many_ranges(spark):
    values = random.Random(1).sample(range(-10_000, 10_000), 1000)
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(5)
    got = {r.v: r.ordinal for r in keyed.with_ordinal(df, "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        parts = keyed.with_ordinal(df, "v").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set(merge, "true")
    assert parts > 1


def test_batch_plan_numbers_all_rows(spark):
    assert rows(keyed.batch_plan(spark.range(100), "id", 3)) == [(i, i // 3) for i in range(100)]
    some = rows(keyed.batch_plan(spark.range(100), "id", batch_size=3, max_batches=4))
    assert some == [(i, i // 3) for i in range(12)]


def test_backlog_is_the_complement_of_done(spark):
    source, done = spark.range(100), spark.range(0, 100, 3)
    todo = bl.not_done(source, done, ["id"])
    assert rows(todo.union(done)) == rows(source)
    portion = bl.backlog(source, done, ["id"], limit=10, seed=1)
    assert portion.count() == 10 and portion.join(done, "id").count() == 0


def test_missing_partner_counts_empty_payloads(spark):
    source = spark.range(4)
    files = spark.createDataFrame([(0, "x"), (1, ""), (2, None)], "id bigint, content string")
    assert rows(bl.missing_partner(source, files, "id", "content")) == [(1,), (2,), (3,)]


def test_stage_flags_do_not_fan_out(spark):
    source = spark.range(3)
    twice = spark.createDataFrame([(0,), (0,), (1,)], "id bigint")
    flagged = bl.stage_flags(source, {"a": twice, "b": spark.range(1)})
    assert rows(flagged) == [(0, 1, 1), (1, 1, 0), (2, 0, 0)]
    assert rows(bl.any_pending(flagged, ["a", "b"]).select("id")) == [(1,), (2,)]
    assert rows(bl.pending_for(flagged, "a").select("id")) == [(2,)]


def test_hash_sample_is_stable_and_near_its_size(spark):
    df = spark.range(20_000)
    first = rows(bl.hash_sample(df, "id", 1000, 20_000))
    assert first == rows(bl.hash_sample(df.repartition(7), "id", 1000, 20_000))
    assert 850 < len(first) < 1150
    assert 850 < bl.md5_sample(df, "id", 1000, 20_000).count() < 1150


def test_missing_heights(spark):
    stored = spark.createDataFrame([(0,), (2,), (2,), (5,)], "height int")
    assert [r[0] for r in bl.missing_heights(spark, stored, 6, "height").collect()] == [1, 3, 4]
    assert [r[0] for r in bl.missing_heights(spark, stored, 6, "height", limit=2).collect()] == [1, 3]


def test_incremental_load_brackets(spark):
    source = spark.createDataFrame([(1, "x"), (5, "x"), (1, "y"), (5, "z")], "ts int, app string")
    target = source.filter("ts < 3")
    search, listed = F.col("app") == "x", F.col("app") == "y"
    assert rows(bl.newer_than_max(source, target, "ts", search | listed)) == [(5, "x")]
    assert rows(bl.newer_than_max_or_listed(source, target, "ts", search, listed)) == [(1, "y"), (5, "x")]
    assert bl.newer_than_max(source, target.limit(0), "ts").count() == 4


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("weight", [None, "n"])
def test_salted_look_up_equals_the_broadcast_one(spark, how, weight):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("term")
    ).unionByName(spark.createDataFrame([(9999, None)], "id bigint, term string"))
    dim = facts.groupBy("term").agg(F.count("*").alias("n")).filter("term <> 'k7'")
    small = lookup(facts, dim, "term", "id", how=how)
    salted = lookup(facts, dim, "term", "id", how=how, weight=weight, max_bytes=5)
    key = lambda df: sorted(map(str, df.select("id", "term", "n").collect()))
    assert key(small) == key(salted)
    assert small.count() == (3001 if how == "left" else 2960)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("weight", [None, "n"])
def test_look_up_of_the_frequent_keys_first_equals_the_broadcast_one(spark, how, weight):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("term")
    ).unionByName(spark.createDataFrame([(9999, None), (9999, "rare")], "id bigint, term string"))
    dim = facts.groupBy("term").agg(F.count("*").alias("n")).filter("term <> 'k7'")
    small = lookup(facts, dim, "term", "id", how=how)
    key = lambda df: sorted(map(str, df.select("id", "term", "n").collect()))
    for max_bytes in (5, 100, 600):
        split = lookup(facts, dim, "term", "id", how=how, weight=weight, max_bytes=max_bytes, frequent_first=True)
        assert split.columns == small.columns
        assert key(split) == key(small)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "broadcast" in plan


def test_term_pipeline(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "")], "id int, body string")
    terms = doc_terms(docs, "body", ngrams=(1, 2))
    assert {(r.id, r.term, r.tf, r.n_terms) for r in terms.collect()} == {
        (1, "a", 2, 5), (1, "b", 1, 5), (1, "a b", 1, 5), (1, "b a", 1, 5),
        (2, "b", 1, 3), (2, "c", 1, 3), (2, "b c", 1, 3),
    }
    stats = term_stats(terms, 3)
    assert {r.term: r.df for r in stats.collect()}["b"] == 2
    assert rows(with_idf(terms, stats).select("id", "term")) == rows(
        with_idf(terms, stats, max_bytes=1).select("id", "term")
    )


def _ratio(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + list(itertools.accumulate(range(len(b)), lambda acc, j: max(
            row[j + 1], acc, row[j] + 1 if x == b[j] else 0), initial=0))[1:]
    return round(100 * 2 * row[-1] / (len(a) + len(b)))


def test_fuzzy_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    words = set()
    while len(words) < 60:
        words.add("".join(rng.choices("abc", k=rng.randint(1, 14))))
    for w in list(words):
        if len(w) > 5:
            i = rng.randrange(len(w))
            words |= {w[:i] + w[i + 1 :], w[:i] + "d" + w[i:], w[:i] + "e" + w[i + 1 :]}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    expected = sorted((a, b, _ratio(a, b)) for a in words for b in words if _ratio(a, b) > 90)
    assert rows(fuzzy.fuzzy_pairs(df, df)) == expected
    assert len(expected) > len(words)


def test_fuzzy_long_words(spark):
    rng = random.Random(5)
    words = set()
    for n in (1, 2, 7, 22, 41, 60):
        for _ in range(5):
            word = [rng.choice("abcd") for _ in range(n)]
            for _ in range(1 + n // 12):
                words.add("".join(word))
                word.insert(rng.randrange(len(word) + 1), rng.choice("abcd"))
                word.pop(rng.randrange(len(word)))
    listed = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    ratio = lambda a, b: round(200 * fuzzy._common_subsequence(a, b) / (len(a) + len(b)))
    want = {(a, b) for a in words for b in words if ratio(a, b) > 90}
    assert {(r.a, r.b) for r in fuzzy.fuzzy_pairs(listed, listed).collect()} == want


def test_words_with_one_common_segment(spark):
    """Candidates grow with the words, not with their pairs, though all share a segment."""
    rng = random.Random(6)
    letters = "bcdfghjklmnpqrstvwxyz"

    def words(n):
        return {"".join(rng.choices(letters, k=6)) + "aeiou" + "".join(rng.choices(letters, k=6)) for _ in range(n)}

    made = sorted(words(20_000))
    changed = [w[:-1] + "u" for w in made[:50]]
    left = spark.createDataFrame([(w,) for w in made], "word string")
    right = spark.createDataFrame([(w,) for w in made + changed], "word string")
    found = fuzzy.candidate_pairs(left, right)
    assert found.count() < 2 * len(made)
    pairs = {(r.a, r.b) for r in fuzzy.fuzzy_pairs(left, right).collect()}
    assert {(w, w) for w in made} | {(w, c) for w, c in zip(made, changed)} <= pairs


def test_low_thresholds_are_refused(spark):
    df = spark.createDataFrame([("abcdefghij",)], "word string")
    with pytest.raises(ValueError, match="fewer grams"):
        fuzzy.candidate_pairs(df, df, threshold=40)


def test_common_subsequence_by_bits():
    rng = random.Random(7)
    for _ in range(300):
        a, b = ("".join(rng.choices("abcé", k=rng.randrange(0, 90))) for _ in range(2))
        rows_ = [[0] * (len(b) + 1)]
        for x in a:
            last = rows_[-1]
            now = [0]
            for j, y in enumerate(b):
                now.append(last[j] + 1 if x == y else max(last[j + 1], now[j]))
            rows_.append(now)
        assert fuzzy._common_subsequence(a, b) == rows_[-1][-1]


def test_fuzzy_counts_repeat_rows(spark):
    left = spark.createDataFrame([("staking",), ("staking",), ("zzz",)], "word string")
    right = spark.createDataFrame([("stakings",), ("staking",)], "word string")
    assert fuzzy.count_matches(left, right).first()[0] == 4
    assert fuzzy.count_matches(left.filter("word = 'zzz'"), right).first()[0] == 0
    lists = spark.createDataFrame(
        [(1, ["staking", "x"], ["stakings", "x", "y"]), (2, [], ["a"]), (3, ["q"], ["a"])],
        "id int, l array<string>, r array<string>",
    )
    assert rows(fuzzy.match_keyword_lists(lists, "id", "l", "r")) == [(1, 2), (2, 0), (3, 0)]


def test_month_and_quantiles(spark):
    d = dt.datetime
    df = spark.createDataFrame(
        [(d(2023, 1, 5), "a"), (d(2023, 1, 9), "a"), (d(2023, 1, 9), None), (d(2023, 2, 1), "b")],
        "ts timestamp, who string",
    )
    assert rows(analytics.monthly_activity(df, "ts", "who")) == [
        (dt.date(2023, 1, 1), 3, 1), (dt.date(2023, 2, 1), 1, 1)
    ]
    counts = spark.createDataFrame([(f"u{i}",) for i in range(4) for _ in range(i + 1)], "who string")
    row = analytics.actor_quantiles(counts, "who", {"m": 0.5, "q": 0.25}).first()
    assert (row.m, row.q) == (2.5, 1.75)
    assert rows(analytics.count_histogram(counts, "who")) == [(1, 1), (2, 1), (3, 1), (4, 1)]


def test_failure_gate(spark):
    good = spark.createDataFrame([(1, "d"), (2, "d"), (3, None)], "id int, created_date string")
    assert rows(analytics.keep_successes_or_fail(good, blk.is_downloaded()).select("id")) == [(1,), (2,)]
    with pytest.raises(ValueError, match="too many failures"):
        analytics.keep_successes_or_fail(good.filter("id > 1").union(good.filter("id = 3")), blk.is_downloaded())


def test_failure_gate_reads_its_batch_once(spark):
    """The batch is evaluated once, and a refused one leaves no table behind."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    batch = spark.range(100).withColumn("created_date", F.when(F.col("id") % 3 != 0, "d"))
    counted = batch.mapInArrow(count, batch.schema)
    before = {t.name for t in spark.catalog.listTables(scratch_table(spark, "x").split(".")[0])}
    assert analytics.keep_successes_or_fail(counted, blk.is_downloaded()).count() == 66
    assert seen.value == 100
    with pytest.raises(ValueError):
        analytics.keep_successes_or_fail(counted, ~blk.is_downloaded())
    after = {t.name for t in spark.catalog.listTables(scratch_table(spark, "x").split(".")[0])}
    assert len(after - before) == 1


def test_storage_report(spark):
    from contentloom.sources.tables import read

    sf = "/root/testdata/sf0.001"
    import os

    report = analytics.storage_report({t: (read(spark, sf, t), None) for t in ("orders", "part")}).collect()
    assert [(r.table, r["size"]) for r in report] == [
        (t, os.path.getsize(f"{sf}/{t}.parquet")) for t in ("orders", "part")
    ]


def test_blocks_and_endpoints(spark):
    raw = spark.createDataFrame(
        [('{"height":5,"timestamp":1700000000}',), ('{"height":6}',), ("{bad",), ("[]",), (None,)],
        "response_str string",
    )
    parsed = blk.parse_blocks(raw).collect()
    assert [(r.height, r.block_timestamp) for r in parsed] == [(5, dt.datetime(2023, 11, 14, 22, 13, 20))]
    registry = spark.createDataFrame(
        [('{"gateways":{"i":{"settings":{"protocol":"https","fqdn":"g8way.io"}},'
          '"j":{"settings":{"protocol":"http","fqdn":"h"}}}}',)], "j string"
    )
    listed = blk.endpoint_list(blk.registry_endpoints(registry, "j"))
    assert listed.count() == len(blk.BASE_ENDPOINTS) + 1
    counts = blk.assign_round_robin(spark.range(23), "id", listed).groupBy("endpoint").count().collect()
    assert sorted(r["count"] for r in counts) == [4, 4, 5, 5, 5]


def test_no_sketch_per_distinct_value(spark, tmp_path):
    """Beside a distinct count the sketch was kept once for every part."""
    spark.createDataFrame([(i % 50,) for i in range(200)] + [(None,)], "l_partkey int").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = analytics_queries.approx_distinct(spark, str(tmp_path))
    assert tuple(found.first()) == (201, 50, True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any("l_partkey" in line and "keys=[l_partkey" in line for line in plan.splitlines() if "approx_count_distinct" in line)
