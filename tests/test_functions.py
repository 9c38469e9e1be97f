"""Column functions on the rows where the semantics are easy to get wrong."""

import hashlib
import math
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F

from contentloom.enrich import scoring
from contentloom.functions import core, fingerprint as fp, html, language, text, vectors
from contentloom.session import apply_settings


def one(df, *cols):
    return df.select(*cols).first()


def texts(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "id int, body string")


def test_char_stats_count_bytes_and_ascii_letters(spark):
    rows = text.with_char_stats(texts(spark, "Hi é you", "", "123 !", "a")).orderBy("id").collect()
    hi, empty, none, single = rows
    assert (hi.alpha_token_count, hi.alpha_char_count, hi.total_char_count) == (2, 5, 9)
    assert hi.non_alpha_ratio == pytest.approx(4 / 9)
    assert (empty.alpha_token_count, empty.total_char_count) == (0, 0)
    assert empty.non_alpha_ratio is None and empty.alpha_ratio is None
    assert (none.alpha_token_count, none.alpha_char_count, none.non_alpha_ratio) == (0, 0, 1.0)
    assert (single.alpha_token_count, single.alpha_ratio) == (1, 1.0)


def test_json_value_of_every_kind(spark):
    raws = [
        '{"a":{"b":"x"},"n":5,"t":["p","q"],"s":"[not a list","e":""}',
        '{"a":',
        None,
    ]
    df = spark.createDataFrame([(r,) for r in raws], "c string")
    got = df.select(
        core.json_value("c", "$.a.b").alias("nested"),
        core.json_value("c", "$.a").alias("object"),
        core.json_value("c", "$.t").alias("array"),
        core.json_value("c", "$.t[1]").alias("item"),
        core.json_value("c", "$.n").alias("number"),
        core.json_value("c", "$.s").alias("bracket"),
        core.json_value("c", "$.zz").alias("missing"),
        core.json_strings("c", "$.t").alias("list"),
    ).collect()
    assert got[0] == Row("x", "", "", "q", "5", "[not a list", "", ["p", "q"])
    assert got[1] == got[2] == Row("", "", "", "", "", "", "", [])


def test_json_string_inside_json(spark):
    df = spark.createDataFrame([('{"content":"{\\"op\\":\\"post\\",\\"body\\":\\"t\\"}"}',)], "c string")
    inner = df.select(core.json_value("c", "$.content").alias("d"))
    assert one(inner, core.json_value("d", "$.body"), core.json_value("d", "$.op"))[:] == ("t", "post")


def test_joined_concat_keeps_the_separator(spark):
    df = spark.createDataFrame([(None, None), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(core.joined_concat(",", "x", "y")).collect()] == [",", "a,"]


def test_comma_free_join(spark):
    df = spark.createDataFrame([(["a,b", "c"],), ([],), (None,)], "m array<string>")
    got = [r[0] for r in df.select(core.comma_free_join(F.col("m"))).collect()]
    assert got == ["ab,c", "", ""]


def test_readable_bytes(spark):
    df = spark.createDataFrame([(512,), (1536,), (5 * 1024**3,)], "n bigint")
    got = [r[0] for r in df.select(core.readable_bytes("n")).collect()]
    assert got == ["512.00 B", "1.50 KiB", "5.00 GiB"]


def test_matching_patterns_and_tags(spark):
    df = spark.createDataFrame(
        [("staking", {"App": "x"}, [Row(name="k", value="v")])],
        "b string, m map<string,string>, p array<struct<name:string,value:string>>",
    )
    row = one(
        df, core.matching_patterns("b", ["eth", "stak", "king"]), core.tag_value("m", "App"),
        core.tag_value("m", "none"), core.tag_value_from_pairs("p", "k"),
        core.tag_value_from_pairs("p", "none"),
    )
    assert row[:] == ([2, 3], "x", None, "v", None)


def test_clean_text_keeps_ascii_letters_digits_and_spaces_by_a_quick_class(spark):
    marks = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 256), 0x2028, 0x1F600]))
    df = texts(spark, f"a{marks}Z  9\x00\x1f{marks}0", None)
    got = [r[0] for r in df.select(text.clean_for_scoring("body")).collect()]
    assert got == ["az 90", None]
    # Java needs some 0.7 microseconds a character for the same class spelt out.
    assert "[^0-9A-Za-z ]" not in str(text.clean_for_scoring("body"))


def test_clean_text_fuses_words_across_line_breaks(spark):
    df = texts(spark, "See http://x.y/z #tag One\nTwo\tthree  it's")
    assert one(df, text.clean_for_scoring("body"))[0] == "see onetwothree its"


def test_normalize_text_matches_python(spark):
    def reference(s):
        s = re.sub(r"\s+", " ", s).strip()
        s = re.sub(r". ,", "", s)
        for old, new in (("..", "."), (". .", "."), ("\n", ""), ("$.", "")):
            s = s.replace(old, new)
        return s.strip()

    bodies = ["a  b\n\tc . , d", "x.. y. . z $.5 w", "", "  lead . ,end  "]
    got = texts(spark, *bodies).orderBy("id").select(text.normalize_text("body")).collect()
    assert [r[0] for r in got] == [reference(s) for s in bodies]


def test_term_counts_equal_python_counter(spark):
    body = "b a b c a b é é z"
    got = one(texts(spark, body, ""), text.term_counts(text.words("body")))[0]
    from collections import Counter

    assert {(t.term, t.tf) for t in got} == set(Counter(body.split()).items())
    rows = texts(spark, "", "x").select(F.size(text.term_counts(text.words("body")))).collect()
    assert [r[0] for r in rows] == [0, 1]


def test_word_ngrams_start_at_every_word(spark):
    df = texts(spark, "one two three four")
    row = one(df, *[text.word_ngrams(F.col("body"), n) for n in (1, 2, 3, 5)])
    assert row[0] == ["one", "two", "three", "four"]
    assert row[1] == ["one two", "two three", "three four"]
    assert row[2] == ["one two three", "two three four"]
    assert row[3] == []


def _python_minhash(body):
    t = body.lower()
    hashes = sorted({hashlib.md5(t[i : i + 3].encode()).hexdigest() for i in range(len(t) - 2)})

    def fold(part):
        u = int(hashlib.md5(",".join(part).encode()).hexdigest()[:16], 16)
        return u - (1 << 64) if u >= 1 << 63 else u

    return fold(hashes[:6]), fold(hashes[::-1][:6])


def test_minhash_pair_hashes_a_shingle_once_for_a_batch(spark):
    bodies = ["Ärger und abc abc", "ab", "", None, "abc", "x\x00\x00\x00 \U0001F600 abc"]

    def fold(hashes):
        n = int(hashlib.md5(",".join(hashes).encode()).hexdigest()[:16], 16)
        return n - 2**64 if n >= 2**63 else n

    def plain(body):
        if body is None:
            return (None, None)
        t = body.lower()
        hs = sorted({hashlib.md5(t[i : i + 3].encode()).hexdigest() for i in range(len(t) - 2)})
        return (fold(hs[:6]), fold(hs[::-1][:6]))

    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string").coalesce(1)
    got = [tuple(r.m) for r in df.orderBy("id").select(fp.minhash_pair("body").alias("m")).collect()]
    assert got == [plain(b) for b in bodies]
    # A string and a hash per shingle and text took a third of the gate's time.
    assert "_distinct_char_shingles" not in str(fp.minhash_pair("body"))


def test_minhash_pair(spark):
    bodies = ["The quick brown fox", "the QUICK brown fox", "ab", "", "ééé aaa", "line\nbreak"]
    rows = texts(spark, *bodies).orderBy("id").select(fp.minhash_pair("body").alias("m")).collect()
    got = [(r.m.h1, r.m.h2) for r in rows]
    assert got == [_python_minhash(s) for s in bodies]
    assert got[0] == got[1]


def _python_simhash(shingles):
    hashes = [int(hashlib.md5(s.encode()).hexdigest()[:16], 16) for s in shingles]
    u = sum(
        1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes)
    )
    return u - (1 << 64) if u >= 1 << 63 else u


def test_simhash(spark):
    bodies = ["Hello World again and again", "héllo wörld 𝒳𝒴𝒵 x", "ab", ""]
    df = texts(spark, *bodies).orderBy("id")
    rows = df.select(fp.simhash_chars("body").alias("c"), fp.simhash_words("body").alias("w")).collect()
    for row, body in zip(rows, bodies):
        low = body.lower()
        assert row.c == _python_simhash([low[i : i + 3] for i in range(len(low) - 2)])
    words = bodies[0].lower().split()
    assert rows[0].w == _python_simhash([" ".join(words[i : i + 3]) for i in range(len(words) - 2)])
    assert rows[2].w == rows[3].w == 0


def test_near_copy_has_near_simhash(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    near = words[:150] + ["changed"] + words[151:]
    other = ["".join(rng.choices("pqrstuv", k=6)) for _ in range(300)]
    df = texts(spark, *(" ".join(w) for w in (words, near, other))).orderBy("id")
    a, b, c = (r[0] & (2**64 - 1) for r in df.select(fp.simhash_chars("body")).collect())
    assert (a ^ b).bit_count() < 8 < (a ^ c).bit_count()


def test_html_text_and_attributes(spark):
    page = (
        '<html><title>T &amp; x</title><style>p{}</style><script>var a="<b>"</script>'
        '<!-- no --><p>Hello\n <b>you</b></p>{"contentUrl": "http://v/1"}</html>'
    )
    df = spark.createDataFrame([(page,), ("plain",)], "h string")
    rows = df.select(
        html.html_text("h"), html.quoted_value("h", "contentUrl"), html.page_title("h")
    ).collect()
    assert rows[0][:] == ('T &amp; x Hello you {"contentUrl": "http://v/1"}', "http://v/1", "T &amp; x")
    assert rows[1][:] == ("plain", "", "")


def test_language_mix(spark):
    labelled = spark.createDataFrame(
        [("the of and in", "en"), ("le la et in", "fr"), ("der die und", "de")], "t string, l string"
    )
    profile = language.collect_profile(language.profile_table(labelled, "t", "l"))
    assert profile["en"] == ["and", "of", "the"] and "in" not in profile["fr"]
    df = texts(spark, "The of THE la unknown", "nothing known", "")
    got = [r[0] for r in df.orderBy("id").select(language.language_mix("body", profile)).collect()]
    assert got == [{"en": 0.75, "fr": 0.25}, {}, {}]
    assert one(df, language.language_mix("body", {}))[0] == {}


def test_cosine(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>"
    )
    got = [r[0] for r in df.select(vectors.cosine_similarity("a", "b")).collect()]
    assert got[0] == pytest.approx(1 / math.sqrt(2)) and got[1] is None


def test_model_hook_loads_once_per_partition(spark):
    def load():
        calls = []

        def model(batch):
            calls.append(1)
            return batch.str.len() + 0 * len(calls)

        return model

    docs = texts(spark, "abc", "", "é" * 20000).withColumn("body", scoring.model_text("body"))
    out = scoring.score_batches(docs, "body", load, "n", "bigint")
    assert out.columns == ["id", "n"]
    assert {r.id: r.n for r in out.collect()} == {0: 3, 1: 0, 2: 20000}


def test_prompts_hold_the_whole_text(spark):
    df = texts(spark, "T" * 15001)
    for task, instruction in scoring.INSTRUCTIONS.items():
        assert one(df, scoring.prompt("body", task))[0] == f"{instruction}\n<text>\n{'T' * 15001}\n</text>"
    assert one(df, scoring.prompt("body", "title", max_chars=10))[0].count("T" * 10 + "\n") == 1


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    table = spark.createDataFrame([(f"l{i}", f"w{i}") for i in range(4)], "lang string, token string")
    with pytest.raises(ValueError, match="languages"):
        language.collect_profile(table)


def test_distinct_char_shingles_are_code_points(spark):
    """As the regex gives them, but for characters beyond 16 bits, which it cut in halves."""
    texts = [None, "", "ab", "abc", "AbcabcABC", "a\0\0a\0\0", "na\u00efve \u6f22\u5b57", "x\U0001f600yz\U0001f600y"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(2)
    got = df.select("id", "t", fp.distinct_char_shingles("t").alias("s"), F.array_distinct(fp.char_shingles("t")).alias("r"))
    for row in got.collect():
        if row.t is None:
            assert row.s is None and row.r is None
            continue
        low = row.t.lower()
        assert sorted(row.s) == sorted({low[i : i + 3] for i in range(len(low) - 2)})
        assert "\U0001f600" in row.t or sorted(row.s) == sorted(row.r)


def test_arrow_batches_are_bounded_by_bytes(spark):
    """10,000 long texts in one batch took gigabytes of a Python worker."""
    apply_settings(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("0123456789"), 2000).alias("t"))
    assert max(r.n for r in texts.mapInArrow(sizes, "n long").collect()) < 20 << 20
