"""Extraction, quality content, enrichment tables, sinks and streams."""

import datetime as dt
import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from contentloom.enrich import entities, phrases, postings, quality, substrings, topics, transcripts
from contentloom.functions import language
from contentloom.operators import terms
from contentloom.plans import content as ct, streaming_queries, wide
from contentloom.session import scratch_path, scratch_root, scratch_table
from contentloom.sources import payloads as pl, tables as tb
from contentloom.streaming import views
from contentloom import schemas

T0 = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def payload_rows(spark):
    post = {"op": "post", "body": "cyber", "ts": "1", "title": "t", "handle": "h", "author": "0x1"}
    raw = [
        ("m", "mirrorxyz", json.dumps({"content": {"body": "mirror", "timestamp": "17", "title": "t"},
                                       "authorship": {"contributor": "0xa"}})),
        ("l", "lenster", json.dumps({"content": "lens", "createdOn": "d", "name": "n", "external_url": "u",
                                     "tags": ["a", "b"], "mainContentFocus": "TEXT_ONLY"})),
        ("v", "hey.xyz", json.dumps({"content": "video", "mainContentFocus": "VIDEO"})),
        ("p", "paragraph", json.dumps({"markdown": "# T", "publishedAt": "17", "title": ["not", "scalar"],
                                       "authors": ["a1", "a2"], "categories": ["c1"]})),
        ("c", "cyberconnect", json.dumps({"content": json.dumps(post)})),
        ("d", "cyberconnect", json.dumps({"content": json.dumps({**post, "op": "like"})})),
        ("x", "mirrorxyz", '{"content":'),
        ("o", "other", "{}"),
    ]
    return spark.createDataFrame(
        [(i, T0, T0, c, a) for i, a, c in raw],
        "id string, created_at timestamp, retrieved_at timestamp, content string, app string",
    )


def test_extraction_per_app_and_in_one_pass(spark):
    df = payload_rows(spark)
    union = ct.content_union([pl.extract_app(df, app) for app in pl.FORMATS])
    got = {r.id: r for r in union.collect()}
    assert set(got) == {"m", "l", "p", "c", "x"}
    assert (got["m"].body, got["m"].contributor, got["m"].tags) == ("mirror", "0xa", [])
    assert (got["l"].body, got["l"].app, got["l"].tags) == ("lens", "lens", ["a", "b"])
    assert (got["p"].title, got["p"].contributor, got["p"].tags) == ("", "a1", ["c1"])
    assert (got["c"].body, got["c"].contributor) == ("cyber", "h")
    assert got["x"].body == ""
    one_pass = pl.extract_all(df)
    assert sorted(map(str, one_pass.select(*sorted(union.columns)).collect())) == sorted(
        map(str, union.select(*sorted(union.columns)).collect())
    )
    assert pl.extract_app(df, "cyberconnect").first().address == "0x1"


def test_one_pass_scans_the_payloads_once(spark, tmp_path):
    payload_rows(spark).write.parquet(str(tmp_path / "p"))
    plan = pl.extract_all(spark.read.parquet(str(tmp_path / "p")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_deep_projection(spark):
    df = payload_rows(spark).filter("app = 'mirrorxyz'")
    got = {r.content_id: r for r in pl.deep_projection(df).collect()}
    assert len(got["m"]) == 27 and got["m"].content == "mirror" and got["m"].wnft_price == ""
    assert got["x"].title == ""


def _content(spark):
    english = "the and of language " * 20
    bodies = [
        ("e1", "lens", english, 2), ("e0", "lens", english.upper(), 1),
        ("vote", "lens", "I JUST VOTED on " + english, 1), ("short", "lens", "the and", 1),
        ("fr", "mirrorxyz", "le la les " * 20, 1), ("num", "mirrorxyz", "1234567 " * 60 + english, 1),
        ("cy", "cyberconnect", english, 1), ("cy2", "cyberconnect", "the and of mountain " * 100, 1),
        ("empty", "mirrorxyz", "", 1), ("od", "odysee", "of and the language " * 15, 1),
    ]
    df = spark.createDataFrame(
        [(i, T0, b, "", "", "", [], T0 + dt.timedelta(hours=h), a) for i, a, b, h in bodies],
        "id string, created_at timestamp, body string, content_timestamp string, title string, "
        "contributor string, tags array<string>, retrieved_at timestamp, app string",
    )
    labelled = spark.createDataFrame([("the and of", "en"), ("le la les", "fr")], "t string, l string")
    profile = language.collect_profile(language.profile_table(labelled, "t", "l"))
    return ct.with_text_stats(df, profile)


def test_gate_and_dedupe(spark):
    content = _content(spark)
    assert {r.id for r in ct.gated(content).collect()} == {"e1", "e0", "cy2", "od"}
    kept = ct.quality_content(content)
    ids = {r.id for r in kept.collect()}
    assert "e0" in ids and "e1" not in ids  # same text but for case: the earlier row stays
    keys = ct.gated(content).select(F.col("ngram_min_hash.h1")).distinct().count()
    assert kept.count() == keys
    again = ct.quality_content(kept.drop("ngram_min_1"))
    assert {r.id for r in again.collect()} == ids
    assert {r.app for r in ct.quality_content(content, "odysee").collect()} == {"odysee"}
    assert {r.id for r in content.filter(ct.strict_quality_gate()).collect()} == {"e0", "e1"}
    stored = tb.to_schema(content, schemas.CONTENT)
    assert stored.columns[-1] == "app" and stored.schema["alpha_token_count"].dataType.simpleString() == "bigint"


def test_values_are_tried_only_where_one_can_start(spark):
    bodies = [
        "May 5, 2023 at 10:30 pm, 7% of $1,000.50 or € 3", "first Second xthird fir 2nd 3 km", "£5 2024-01-02 Mayor",
        " ".join(f"{m} 1" for m in entities.MONTHS.split("|")), "no value", "", None,
    ]
    docs = spark.createDataFrame(list(enumerate(bodies)), "id bigint, body string")
    got, plain = (
        entities.value_mentions(docs, patterns=p) for p in (entities.VALUE_PATTERNS, dict(entities.VALUE_PATTERNS))
    )
    listed = lambda df: sorted(map(tuple, df.collect()))
    assert listed(got) == listed(plain) and got.count() == 24
    assert entities.VALUE_STARTS in got._jdf.queryExecution().analyzed().toString()


def test_english_quality(spark):
    docs = spark.createDataFrame(
        [(1, "The cat http://x.y sat"), (2, ""), (3, "zzz"), (4, "cats")], "id int, body string"
    )
    vocabulary = spark.createDataFrame([("the",), ("cat",)], "word string")
    got = {r.id: r.eng_quality for r in quality.english_quality(docs, vocabulary).collect()}
    assert got == {1: pytest.approx(7 / 22), 2: 0.0, 3: 0.0, 4: 0.0}
    lemmas = spark.createDataFrame([("cats", "cat"), ("sat", "sit")], "token string, lemma string")
    with_lemmas = quality.english_quality(docs, vocabulary, lemmas=lemmas)
    assert {r.id: r.eng_quality for r in with_lemmas.collect()}[4] == 1.0
    salted = quality.english_quality(docs, vocabulary, max_bytes=0)
    assert {r.id: r.eng_quality for r in salted.collect()} == got
    stored = quality.quality_rows(docs, quality.english_quality(docs, vocabulary))
    assert "body" not in stored.columns and stored.filter("passes_target").count() == 1


def test_entities(spark):
    docs = spark.createDataFrame(
        [(1, "New York, New York and York by Jane Doe."), (2, "nobody"), (3, "7% of $5 on 2024-01-02")],
        "id int, body string",
    )
    gazetteer = spark.createDataFrame(
        [("New York", "GPE"), ("York", "GPE"), ("Jane Doe", "PERSON"), ("Jane Doe", "ORG")],
        "mention string, ent_type string",
    )
    named = entities.gazetteer_mentions(docs, gazetteer)
    assert [(r.pos, r.mention) for r in named.filter("ent_type = 'GPE'").orderBy("pos").collect()] == [
        (0, "New York"), (2, "New York"), (5, "York")
    ]
    table = entities.entity_table(docs.select("id"), named, schemas.ENTITY_TYPES_11)
    got = {r.id: r for r in table.collect()}
    assert set(got) == {1, 2, 3}
    assert got[1].gpe_entities == "New York,York"
    assert got[1].person_entities == got[1].org_entities == "Jane Doe"
    assert set(got[2][1:]) == {""}
    both = named.unionByName(entities.value_mentions(docs))
    wide18 = entities.entity_table(docs.select("id"), both, schemas.ENTITY_TYPES_18, first_seen=False)
    three = next(r for r in wide18.collect() if r.id == 3)
    assert (three.percent_entities, three.money_entities, three.date_entities) == ("7%", "$5", "2024-01-02")
    assert rows(entities.gazetteer_mentions(docs, gazetteer, max_bytes=1)) == rows(named)


def test_a_value_has_one_type_and_its_place(spark):
    text = "On 2024-01-05 paid $1,200.50 for the 3rd time, 12 km at 10:30 am, 5 of 7%."
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, body string")
    got = sorted((r.pos, r.ent_type, r.mention) for r in entities.value_mentions(docs).collect())
    assert got == [
        (1, "DATE", "2024-01-05"), (5, "MONEY", "$1,200.50"), (10, "ORDINAL", "3rd"), (12, "QUANTITY", "12 km"),
        (15, "TIME", "10:30 am"), (18, "CARDINAL", "5"), (20, "PERCENT", "7%"),
    ]


def test_mention_with_comma_loses_it(spark):
    mentions = spark.createDataFrame(
        [(1, "ORG", 4, "A, Inc"), (1, "ORG", 0, "B"), (1, "ORG", 9, "B")],
        "id int, ent_type string, pos int, mention string",
    )
    table = entities.entity_table(mentions.select("id").distinct(), mentions, ["ORG"])
    assert table.first().org_entities == "B,A Inc"


def test_topics(spark):
    docs = spark.createDataFrame([(1, "guitar guitar song"), (2, "bank"), (3, "")], "id int, body string")
    seeds = spark.createDataFrame(
        [("music", "guitar", 9.0), ("music", "song", 9.0), ("finance", "bank", 0.1), ("tech", "bank", 0.2)],
        "label string, term string, weight double",
    )
    got = {r.id: r for r in topics.topic_scores(docs, seeds, 3).collect()}
    assert len(got[1].categories) == 14 and got[1].categories["sports"] == 0.0
    assert got[1].top_categories == got[1].categories_over_threshold == "music"
    assert got[2].top_categories == "" and got[2].categories["tech"] > got[2].categories["finance"] > 0
    assert set(got[3].categories.values()) == {0.0}
    empty = spark.createDataFrame([({},)], "c map<string,double>")
    assert empty.select(topics.top_category("c"), topics.categories_over("c")).first()[:] == ("", "")
    two = spark.createDataFrame([({"a": 0.8, "b": 0.9},)], "c map<string,double>")
    assert two.select(topics.top_category("c"), topics.categories_over("c")).first()[:] == ("b", "b,a")


def test_phrases_summaries_titles_styles(spark):
    docs = spark.createDataFrame(
        [(1, "Rare zebra runs. The the. The rare quagga sleeps! The end."), (2, ""), (3, "the the the")],
        "id int, body string",
    )
    kw = {r.id: r.keywords for r in phrases.keyphrases(docs, 3, k=2).collect()}
    assert set(kw) == {1, 2, 3} and kw[2] == "" and kw[3] == "the,the the"
    assert {r.id: r.keywords for r in phrases.keyphrases(docs, 3, k=2, max_bytes=1).collect()} == kw
    summary = {r.id: r.summary for r in phrases.summaries(docs, 3, k=2).collect()}
    assert summary == {1: "Rare zebra runs. The rare quagga sleeps!", 2: "", 3: "the the the"}
    title = {r.id: r.title for r in phrases.titles(docs, 3, n_words=2).collect()}
    assert title == {1: "Rare zebra", 2: "", 3: "the the"}
    style = {r.id: r.style for r in phrases.style_profile(docs).collect()}
    assert style == {1: "terse", 2: "empty", 3: "terse"}
    vector = {r.id: r.embedding for r in phrases.hashed_embeddings(docs, 3, dim=16).collect()}
    assert set(vector) == {1, 2, 3} and vector[2] == [0.0] * 16
    assert all(sum(x * x for x in vector[i]) == pytest.approx(1.0) for i in (1, 3))


def plain_keyphrases(docs, n_docs, k):
    """Every term of every text scored."""
    tfs = []
    for i, text in docs:
        w = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        tfs.append((i, Counter(w + [" ".join(p) for p in zip(w, w[1:])])))
    df = Counter(t for _, tf in tfs for t in tf)
    scored = {}
    for i, tf in tfs:
        found = ((-round(n * (math.log((1 + n_docs) / (1 + df[t])) + 1), 6), t) for t, n in tf.items())
        scored.setdefault(i, []).extend(found)
    return {i: ",".join(t for _, t in sorted(found)[:k]) for i, found in scored.items()}


def skewed_texts(n):
    """Long and short texts, with NULL, without words, with an id twice, in two scripts."""
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "abcdefghijklmnop" for b in ("x", "y", "é", "ж", "zz")]
    weights = [1 / (n + 1) ** 1.3 for n in range(len(words))]
    sizes = [(1, 2, 5, 20, 60, 400)[i % 6] for i in range(n)]
    texts = [(i, ". ".join(rng.choices(words, weights, k=size))) for i, size in enumerate(sizes)]
    return [*texts, (3, "zebra ax"), (1000, None), (1001, ""), (1002, "12 - 3"), (1003, "ax ax ax ax")]


@pytest.mark.parametrize("max_bytes", [1, 2000, 1 << 20])
def test_keyphrases_equal_plain_ones(spark, max_bytes):
    """No, some and all words are sent to the tasks."""
    docs = skewed_texts(240)
    df = spark.createDataFrame(docs, "id int, body string").repartition(3)
    for n_docs, k in ((len(docs), 5), (20, 1)):
        got = {r.id: r.keywords for r in phrases.keyphrases(df, n_docs, k=k, max_bytes=max_bytes).collect()}
        assert got == plain_keyphrases(docs, n_docs, k)


def test_keyphrases_shuffle_few_terms(spark, monkeypatch):
    """All terms of all texts were shuffled, several times; 6 GB of texts filled the disk."""
    docs = spark.createDataFrame(skewed_texts(240), "id int, body string")
    every = terms.stored_doc_terms(docs, "body", (1, 2))
    few, stats = terms.contending_terms(docs, "body", 245, 5)
    assert few.count() < every.count() / 4
    df = {r.term: r.df for r in terms.term_stats(every, 245).collect()}
    counted = {r.term: r.df for r in stats.collect()}
    assert set(counted) >= {r.term for r in few.collect()} and all(df[t] == n for t, n in counted.items())
    asked = []
    monkeypatch.setattr(phrases, "with_idf", lambda t, *args, **more: asked.append(t.count()) or terms.with_idf(t, *args, **more))
    phrases.keyphrases(docs, 245).collect()
    assert asked == [few.count()]


def test_terms_counted_in_batches(spark, monkeypatch):
    """The same rows as counted in the row, also with many batches."""
    docs = spark.createDataFrame(skewed_texts(60), "id int, body string").repartition(2)
    monkeypatch.setattr(terms, "TEXT_BYTES", 300)
    for ngrams in ((1,), (1, 2), (3, 1)):
        got, want = (f(docs, "body", ngrams, "id") for f in (terms._counted, terms._listed))
        plain = lambda df: sorted((r.id, r.n_terms, sorted(r._t)) for r in df.filter("_t IS NOT NULL").collect())
        assert plain(got) == plain(want)


def test_transcripts_from_unordered_segments(spark):
    segments = spark.createDataFrame(
        [("f", "u", "world", 5.0, 9.2), ("f", "u", "hello", 0.0, 5.0), ("g", "w", "x", 0.0, 1.0)],
        "file_id string, file_url string, text string, segment_start double, segment_end double",
    )
    got = {r.source_url: r for r in transcripts.transcripts(transcripts.with_segment_ids(segments)).collect()}
    assert (got["f"].fulltext, got["f"].download_url, got["f"].length_in_s) == ("hello world", "u", 10)
    assert [s["segment_id"] for s in json.loads(got["f"].transcription_json)] == [0, 1]


def test_conjunctions_open_few_blocks(spark):
    """Against a scan, for terms of all frequencies; only the terms' partitions are read, and
    ids of the blocks that all terms have."""
    rng = random.Random(2)
    vocabulary = [f"t{i}" for i in range(30)]
    docs = [(i * 7, " ".join(w for n, w in enumerate(vocabulary) if rng.random() < 1 / (n + 1))) for i in range(3000)]
    posts = postings.postings(spark.createDataFrame(docs, "id bigint, body string"))
    table = scratch_table(spark, "blocks")
    postings.write_posting_blocks(postings.posting_blocks(posts, block=256), table, buckets=16)
    stored = spark.table(table)
    for terms in (["t0", "t1"], ["t2", "t20"], ["t0", "t5", "t9"], ["t25", "t26"]):
        found = postings.find_all_stored(stored, terms, buckets=16)
        want = sorted((i,) for i, body in docs if set(terms) <= set(body.split()))
        assert rows(found) == want
    plan = postings.find_all_stored(stored, ["t2", "t20"], buckets=16)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(term_bucket" in plan and "GreaterThanOrEqual(block" in plan


def test_substring_index_equals_a_scan(spark):
    rng = random.Random(4)
    docs = [(i, "".join(rng.choices("abcde É\n.", k=rng.randrange(0, 60)))) for i in range(400)] + [(900, None), (901, "ABC abé")]
    table = scratch_table(spark, "trigrams")
    frame = spark.createDataFrame(docs, "id bigint, body string")
    substrings.write_substring_index(frame, table, buckets=8, block=64)
    stored = spark.table(table)
    for patterns in (["abc"], ["aBcd", "e.a"], ["é a", "dd"], ["a"], ["zzz"], ["nowhere", "bad e"], []):
        for match_all in (True, False):
            for ignore in (True, False):
                fold = (lambda s: s.lower()) if ignore else (lambda s: s)
                tests = lambda body: [fold(p) in fold(body) for p in patterns]  # noqa: B023, E731
                want = sorted((i,) for i, body in docs if body is not None and (all if match_all else any)(tests(body)))
                found = substrings.containing(frame, stored, patterns, match_all, buckets=8, ignore_case=ignore)
                if patterns or not match_all:
                    assert rows(found.select("id")) == want, (patterns, match_all, ignore)
    few = substrings.candidates(frame, stored, ["abcd"], True, buckets=8)
    assert few.count() <= 3 * frame.filter("contains(lower(body), 'abcd')").count() + 5


def test_postings(spark):
    docs = spark.createDataFrame([(1, "The cat"), (5000, "the dog the")], "id bigint, body string")
    posts = postings.postings(docs)
    assert rows(posts) == [("cat", 1), ("dog", 5000), ("the", 1), ("the", 5000)]
    blocks = postings.posting_blocks(posts).filter("term = 'the'")
    assert [(r.block, r.ids) for r in blocks.orderBy("block").collect()] == [(0, [1]), (1, [5000])]
    assert rows(postings.find_all(posts, ["the", "Dog"])) == [(5000,)]
    table = scratch_table(spark, "blocks")
    postings.write_posting_blocks(postings.posting_blocks(posts), table, buckets=4)
    stored = spark.table(table)
    for terms, want in ((["the", "Dog"], [(5000,)]), (["THE"], [(1,), (5000,)]), (["cat", "dog"], []), (["the", "absent"], []), ([], [])):
        assert rows(postings.find_all_stored(stored, terms, buckets=4)) == want, terms
    path = scratch_path(spark, "p")
    postings.write_postings(posts, path, buckets=4)
    found = postings.stored_ids(spark.read.parquet(path), "The", buckets=4)
    assert rows(found) == [(1,), (5000,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(term_bucket" in plan


def test_wide_view_takes_the_newest_row_per_id(spark):
    content = ct.quality_content(_content(spark))
    ids = content.select("id")

    def table(columns, stamp):
        return ids.filter("id = 'e0'").select(
            "id", *[F.lit(f"{c[:2]}{stamp}").alias(c) for c in columns],
            F.lit(f"2024-01-0{stamp}").cast("timestamp").alias("created_at"),
        )

    def both(columns):
        return table(columns, 1).unionByName(table(columns, 2))

    cats = both(["top_categories"]).withColumn("categories", F.create_map(F.lit("a"), F.lit(0.5)))
    view = wide.wide_metadata(
        content, both(schemas.entity_columns(schemas.ENTITY_TYPES_11)),
        both(schemas.entity_columns(schemas.ENTITY_TYPES_18)), both(["keywords"]), cats,
    )
    got = {r.id: r for r in view.collect()}
    assert len(got) == view.count() == content.count()
    assert got["e0"].person_entities == "pe2,pe2" and got["e0"].keywords == "ke2"
    assert got["od"].person_entities == "," and got["od"].keywords == ""
    assert got["od"].categories is None and json.loads(got["e0"].categories) == {"a": 0.5}
    assert json.loads(got["e0"].languages) == {"en": 1.0}


def test_tables(spark):
    table = scratch_table(spark, "t")
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, ver int")
    old.write.format("parquet").saveAsTable(table)
    new = spark.createDataFrame([(2, "B", 2), (3, "c", 2)], "k int, v string, ver int")
    for _ in range(2):
        tb.keyed_replace(new, table, ["k"], ["ver"])
        assert rows(spark.table(table)) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]
    tb.append(new.withColumn("extra", F.lit("heavy")), table)
    tb.deduplicate(table, spark, ["k"])
    assert spark.table(table).count() == 3
    tb.delete_where(table, spark, F.col("k") > F.when(F.col("k") == 3, F.lit(None)).otherwise(1))
    assert [r[0] for r in rows(spark.table(table))] == [1, 3]
    tb.rebuild_and_swap(spark.table(table).withColumn("d", F.col("k") * 2), table)
    assert spark.table(table).columns == ["k", "v", "ver", "d"]
    with pytest.raises(ValueError, match="missing"):
        tb.append(new.drop("v").withColumn("d", F.lit(1)), table)


def test_rebuilt_tables_keep_their_layout(spark):
    df = spark.createDataFrame([(i, i % 3, "x") for i in range(30)], "k int, d int, v string")
    parts, buckets = scratch_table(spark, "p"), scratch_table(spark, "b")
    tb.write_clustered(df, parts, ["k"], partition_by=["d"])
    tb.write_bucketed(df, buckets, ["k"], 4)
    before = tb.layout_of(spark, parts), tb.layout_of(spark, buckets)
    assert before == (tb.Layout(("d",)), tb.Layout((), 4, ("k",), ("k",)))
    newer = df.filter("k < 5").withColumn("v", F.lit("y"))
    for table in (parts, buckets):
        tb.keyed_replace(newer, table, ["k"], ["d"])  # equal order values: the insert wins
        tb.delete_where(table, spark, F.col("k") == 7)
        assert spark.table(table).count() == 29
        assert spark.table(table).filter("v = 'y'").count() == 5
    assert (tb.layout_of(spark, parts), tb.layout_of(spark, buckets)) == before
    names = {t.name for t in spark.catalog.listTables(parts.split(".")[0])}
    assert not any(n.endswith(("_rebuilt", "_replaced")) for n in names)


def test_deletes_touch_only_partitions_with_such_rows(spark):
    df = spark.createDataFrame([(i, i % 3, "x") for i in range(30)] + [(100, None, "n")], "k int, d int, v string")
    table = scratch_table(spark, "p")
    tb.write_clustered(df, table, ["k"], partition_by=["d"])
    before = set(spark.table(table).inputFiles())
    tb.delete_where(table, spark, F.col("k") == 5000)
    assert set(spark.table(table).inputFiles()) == before
    tb.delete_where(table, spark, (F.col("d") == 1) | (F.col("k") == 3))
    after = set(spark.table(table).inputFiles())
    assert rows(spark.table(table).select("k")) == sorted((i,) for i in [*range(30), 100] if i == 100 or (i % 3 != 1 and i != 3))
    assert {f.split("/d=")[1].split("/")[0] for f in before & after} == {"2", "__HIVE_DEFAULT_PARTITION__"}
    assert not any("/d=1/" in f for f in after) and len(spark.sql(f"SHOW PARTITIONS {table}").collect()) == 3
    tb.delete_where(table, spark, F.col("k") == 100)
    assert spark.table(table).count() == 19


def test_bucketed_tables_join_without_a_shuffle(spark):
    left, right = scratch_table(spark, "l"), scratch_table(spark, "r")
    for table in (left, right):
        tb.write_bucketed(spark.range(100), table, ["id"], 4)
    joined = spark.table(left).hint("merge").join(spark.table(right), "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 100


def test_counts_by_app_match_the_tables(spark):
    content = _content(spark)
    before = {r.app: r["count"] for r in ct.gated(content).groupBy("app").count().collect()}
    after = {r.app: r["count"] for r in ct.quality_content(content).groupBy("app").count().collect()}
    got = {r.app: (r.before_dedupe, r.after_dedupe) for r in ct.counts_by_app(content).collect()}
    assert got == {a: (n, after.get(a, 0)) for a, n in before.items()}


def test_partition_merge_leaves_other_days_alone(spark):
    table = scratch_table(spark, "days")
    df = spark.createDataFrame([(1, 1, "d1"), (1, 1, "d2")], "k int, ver int, day string")
    df.write.format("parquet").partitionBy("day").saveAsTable(table)
    before = {r[0] for r in spark.table(table).filter("day = 'd1'").select("_metadata.file_path").collect()}
    new = spark.createDataFrame([(1, 2, "d2"), (7, 2, "d3")], "k int, ver int, day string")
    tb.keyed_replace_partitions(new, table, ["day", "k"], ["ver"], "day")
    assert rows(spark.table(table)) == [(1, 1, "d1"), (1, 2, "d2"), (7, 2, "d3")]
    after = {r[0] for r in spark.table(table).filter("day = 'd1'").select("_metadata.file_path").collect()}
    assert before == after
    with pytest.raises(ValueError):
        tb.keyed_replace_partitions(new, table, ["k"], ["ver"], "day")


def test_scratch_root_is_the_configured_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_streams_equal_batch_over_several_files(spark, tmp_path):
    folder = str(tmp_path / "in")
    df = spark.createDataFrame(
        [(i % 4, i, T0 + dt.timedelta(hours=i)) for i in range(60)], "k int, v int, ts timestamp"
    )
    for lo in range(0, 60, 20):
        df.filter((F.col("v") >= lo) & (F.col("v") < lo + 20)).coalesce(1).write.mode("append").parquet(folder)

    def stream():
        return views.file_stream(spark, folder, df.schema, files_per_batch=1)

    index = spark.createDataFrame([(0, T0, T0, "a", 9), (1, T0, T0, "b", 8)],
                                  "id int, created_at_dt timestamp, created_at timestamp, app string, data_size int")
    cache = lambda d: d.select(F.col("k").alias("id"), F.col("ts").alias("retrieved_at"))
    streamed = views.materialize(views.tracker(cache(stream()), index), "tracker")
    assert rows(streamed) == rows(views.tracker(cache(df), index)) and streamed.count() == 30

    table = scratch_table(spark, "latest")
    spark.createDataFrame([], df.schema).write.format("parquet").saveAsTable(table)
    checkpoint = scratch_path(spark, "cp")
    for _ in range(2):  # the second start finds nothing new
        views.keyed_replace_stream(
            stream(), ["k"], ["v"], lambda b: tb.keyed_replace(b, table, ["k"], ["v"]), checkpoint
        )
        assert rows(spark.table(table).select("k", "v")) == [(k, 56 + k) for k in range(4)]

    first = views.materialize(views.first_seen(stream(), ["k"], "ts", "10 days").select("k"), "first")
    assert rows(first) == [(k,) for k in range(4)]

    daily = views.materialize(views.daily_counts(stream(), "ts", "k", "0 seconds"), "daily")
    assert [(r.n, r.actors) for r in daily.orderBy("day").collect()] == [(24, 4), (24, 4)]


def test_streams_read_a_table_that_is_a_folder(spark, tmp_path):
    """A table is one file or a folder of part files; streams passed over the latter."""
    sf = str(tmp_path)
    docs = spark.createDataFrame(
        [(i, f"text {i}", "en", f"src{i}", 6) for i in range(20)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs.repartition(3).write.parquet(f"{sf}/documents.parquet")
    turns = spark.createDataFrame([(c, t, "user", f"turn {t}") for c in range(3) for t in range(2)], "conv_id long, turn int, role string, text string")
    turns.repartition(2).write.parquet(f"{sf}/conversations.parquet")
    found = {name: streaming_queries.FAMILY.queries[name](spark, sf) for name in ("stream_tracker", "stream_transcripts")}
    assert sorted(r.id for r in found["stream_tracker"].collect()) == list(range(20))
    assert sorted(r.body for r in found["stream_transcripts"].collect()) == ["turn 0"] * 3 + ["turn 1"] * 3
