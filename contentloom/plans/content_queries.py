"""Extraction, text statistics, fingerprints, language mix and quality content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contentloom.enrich import substrings
from contentloom.functions import fingerprint as fp, html as html_fn, text as text_fn
from contentloom.functions.core import computed_once, matching_patterns
from contentloom.functions.variants import parsed, read_once, schema_report
from contentloom.functions.language import language_mix
from contentloom.operators import analytics
from contentloom.operators import hamming
from contentloom.plans import bindings as b
from contentloom.plans.content import (
    content_union,
    counts_by_app,
    quality_content,
    strict_quality_gate,
    with_gate_stats,
)
from contentloom.plans.registry import Family
from contentloom.sources.payloads import (
    DEEP_FIELDS,
    FORMATS,
    deep_projection,
    extract_all,
    extract_app,
    transcript_content,
)
from contentloom.session import scratch_table, written
from contentloom.sources.tables import read

FAMILY = Family()
query = FAMILY.query


def r6(c) -> F.Column:
    return F.round(c, 6)


# ---- text statistics -------------------------------------------------------------


@query(
    "text_stats",
    f"""WITH {b.DOCS}, {b.stats_cte('docs')}
SELECT id, alpha_token_count, alpha_char_count, total_char_count, non_alpha_char_count,
  round(non_alpha_ratio, 6) AS non_alpha_ratio, round(alpha_ratio, 6) AS alpha_ratio
FROM stats"""
)
def text_stats(spark: SparkSession, sf: str) -> DataFrame:
    return text_fn.with_char_stats(b.documents(spark, sf).select("id", "body")).select(
        "id", "alpha_token_count", "alpha_char_count", "total_char_count",
        "non_alpha_char_count", r6("non_alpha_ratio").alias("non_alpha_ratio"),
        r6("alpha_ratio").alias("alpha_ratio"),
    )


@query(
    "minhash_pair",
    f"""WITH {b.DOCS}, {b.minhash_cte('docs')} SELECT id, h1, h2 FROM minhash"""
)
def minhash_pair(spark: SparkSession, sf: str) -> DataFrame:
    return (
        b.documents(spark, sf)
        .select("id", fp.minhash_pair("body").alias("m"))
        .select("id", "m.h1", "m.h2")
    )


def _folded_cte(shingles: str, source: str, name: str = "folded") -> str:
    """CTE ``folded(id, u)``: majority bits over the shingles of every text."""
    bits = " + ".join(
        f"CASE WHEN 2 * sum((h >> {i}) & 1) > count(*) THEN {1 << i}::HUGEINT ELSE 0 END"
        for i in range(64)
    )
    return f"""{name} AS (SELECT id, {bits} AS u FROM (
    SELECT id, CAST('0x' || substr(md5(g), 1, 16) AS UBIGINT) AS h
    FROM (SELECT id, unnest({shingles}) AS g FROM {source})) GROUP BY id)"""


SIGNED = """CAST(coalesce(u - CASE WHEN u >= 9223372036854775808 THEN 18446744073709551616 ELSE 0 END, 0)
  AS BIGINT)"""
_CHAR_SHINGLES = "list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))"
_WORD_SHINGLES = (
    "list_transform(range(1, len(w) - 1), lambda i: list_extract(w, i) || ' ' "
    "|| list_extract(w, i + 1) || ' ' || list_extract(w, i + 2))"
)


@query(
    "simhash_chars",
    f"""WITH {b.DOCS}, {_folded_cte(_CHAR_SHINGLES, '(SELECT id, lower(body) AS t FROM docs)')}
SELECT id, {SIGNED} AS simhash FROM docs LEFT JOIN folded USING (id)""",
)
def simhash_chars(spark: SparkSession, sf: str) -> DataFrame:
    return b.documents(spark, sf).select("id", fp.simhash_chars("body").alias("simhash"))


@query(
    "simhash_near_pairs",
    f"""WITH {b.DOCS}, {_folded_cte(_CHAR_SHINGLES, '(SELECT id, lower(body) AS t FROM docs)')},
prints AS (SELECT id, {SIGNED} AS v FROM docs LEFT JOIN folded USING (id)),
vals AS (SELECT v, count(*) AS n FROM prints GROUP BY v)
SELECT x.v AS a, y.v AS b, CAST(bit_count(xor(x.v, y.v)) AS INTEGER) AS distance, x.n AS n_a, y.n AS n_b
FROM vals x JOIN vals y ON x.v < y.v WHERE bit_count(xor(x.v, y.v)) <= 3""",
)
def simhash_near_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints at most three bits apart, with the number of documents of each."""
    prints = b.documents(spark, sf).select("id", fp.simhash_chars("body").alias("simhash"))
    values, _ = hamming.clusters(prints, "id", "simhash")
    values = written(values, "fingerprints")
    pairs = hamming.near_fingerprints(values)
    for side in "ab":
        n = values.select(F.col("value").alias(side), F.col("n").alias(f"n_{side}"))
        pairs = pairs.join(n, side)
    return pairs


@query(
    "simhash_word_shingles",
    f"""WITH {b.DOCS}, {_folded_cte(_WORD_SHINGLES, f"(SELECT id, {b.sql_words('body')} AS w FROM docs)")}
SELECT id, {SIGNED} AS simhash FROM docs LEFT JOIN folded USING (id)""",
)
def simhash_word_shingles(spark: SparkSession, sf: str) -> DataFrame:
    return b.documents(spark, sf).select("id", fp.simhash_words("body").alias("simhash"))


@query(
    "sha1_hex",
    """SELECT doc_id AS id, upper(sha1(text)) AS sha1_content_hash,
  upper(hex(upper(sha1(text)))) AS hex_of_hash FROM documents"""
)
def sha1_hex(spark: SparkSession, sf: str) -> DataFrame:
    digest = fp.sha1_hex("body")
    return b.documents(spark, sf).select(
        "id", digest.alias("sha1_content_hash"), F.hex(digest).alias("hex_of_hash")
    )


@query(
    "language_mix",
    f"""WITH {b.DOCS}, {b.PROFILE}, {b.mix_cte('docs')}
SELECT id, coalesce(string_agg(lang || '=' || CAST(CAST(round(share * 10000) AS BIGINT) AS VARCHAR), ',' ORDER BY pos), '')
  AS languages
FROM docs LEFT JOIN mix USING (id) GROUP BY id""".replace("lang || '='", "mix.lang || '='")
)
def language_mix_map(spark: SparkSession, sf: str) -> DataFrame:
    mix = language_mix("body", b.language_profile(spark, sf))
    pairs = F.transform(
        F.map_entries("languages"),
        lambda e: F.concat(
            e["key"], F.lit("="), F.round(e["value"] * 10000).cast("bigint").cast("string")
        ),
    )
    return (
        b.documents(spark, sf)
        .select("id", mix.alias("languages"))
        .select("id", F.array_join(pairs, ",").alias("languages"))
    )



@query(
    "long_text_filter",
    """SELECT doc_id AS id, upper(sha1(text)) AS h,
  CAST(len(regexp_extract_all(text, '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) AS BIGINT) AS n_tokens
FROM documents
WHERE strlen(text) > 100 AND len(regexp_extract_all(text, '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) > 100"""
)
def long_text_filter(spark: SparkSession, sf: str) -> DataFrame:
    return (
        b.documents(spark, sf)
        .filter(F.octet_length("body") > 100)
        .select(
            "id", fp.sha1_hex("body").alias("h"),
            F.size(text_fn.general_tokens("body")).cast("bigint").alias("n_tokens"),
        )
        .filter(F.col("n_tokens") > 100)
    )


# ---- cleaning --------------------------------------------------------------------

_DECORATED = "text || chr(10) || 'see https://example.org/a?b=1 #Tag_1 now .. ok . , yes $.5 end. . x' || chr(9) || 'y'"


def _decorated(spark: SparkSession, sf: str) -> DataFrame:
    tail = "\nsee https://example.org/a?b=1 #Tag_1 now .. ok . , yes $.5 end. . x\ty"
    return b.documents(spark, sf).select("id", F.concat("body", F.lit(tail)).alias("body"))


@query(
    "clean_text",
    f"""SELECT doc_id AS id, lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({_DECORATED}),
  'http\\S+', ' ', 'g'), '#[A-Za-z0-9_]+', '', 'g'), '[^0-9A-Za-z ]', '', 'g'), ' +', ' ', 'g')) AS clean
FROM documents"""
)
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return _decorated(spark, sf).select("id", text_fn.clean_for_scoring("body").alias("clean"))


@query(
    "normalize_text",
    f"""SELECT doc_id AS id, trim(replace(replace(replace(replace(
  regexp_replace(trim(regexp_replace({_DECORATED}, '\\s+', ' ', 'g')), '. ,', '', 'g'),
  '..', '.'), '. .', '.'), chr(10), ''), '$.', '')) AS normal
FROM documents"""
)
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return _decorated(spark, sf).select("id", text_fn.normalize_text("body").alias("normal"))


@query(
    "truncate_text",
    """SELECT doc_id AS id, substr(text, 1, 15000) AS cut,
  CAST(length(substr(text, 1, 100000)) AS BIGINT) AS short_chars FROM documents"""
)
def truncate_text(spark: SparkSession, sf: str) -> DataFrame:
    return b.documents(spark, sf).select(
        "id", text_fn.truncate("body", 15_000).alias("cut"),
        F.char_length(text_fn.truncate("body", 100_000)).cast("bigint").alias("short_chars"),
    )


# ---- HTML and JSON ---------------------------------------------------------------


@query(
    "html_text",
    """SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '(?s)<!\\[CDATA\\[.*?\\]\\]>', ' ', 'g'),
  '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'),
  '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS visible FROM pages"""
)
def html_text(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select(
        "page_id", html_fn.html_text("html").alias("visible")
    )


@query(
    "html_attr_extract",
    """SELECT page_id, regexp_extract(html, 'href="([^"]*)"', 1) AS first_link,
  regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
  url || '/media' AS content_url, '' AS missing FROM pages"""
)
def html_attr_extract(spark: SparkSession, sf: str) -> DataFrame:
    linked = F.concat(
        "html", F.lit('{"contentUrl": "'), "url", F.lit('/media", "x": "y"}')
    )
    return read(spark, sf, "pages").select(
        "page_id",
        html_fn.attribute("html", "href").alias("first_link"),
        html_fn.page_title("html").alias("title"),
        html_fn.quoted_value(linked, "contentUrl").alias("content_url"),
        html_fn.quoted_value("html", "contentUrl").alias("missing"),
    )


@query(
    "json_paths",
    """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k, '' AS missing,
  CASE WHEN event_id % 10 = 0 THEN '' ELSE coalesce(json_extract_string(props, '$.k'), '') END AS k_or_malformed
FROM events"""
)
def json_paths(spark: SparkSession, sf: str) -> DataFrame:
    broken = F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 5)).otherwise(
        F.col("props")
    )
    rows = read(spark, sf, "events").select("event_id", "props", broken.alias("broken"))
    whole = {"k": ("$.k", "text"), "missing": ("$.nope.deep", "text")}
    read_both = computed_once(
        rows, {"_p": read_once("props", whole), "_b": read_once("broken", {"k": ("$.k", "text")})}
    )
    return read_both.select("event_id", "_p.k", "_p.missing", F.col("_b.k").alias("k_or_malformed"))


@query(
    "json_schema_report",
    """WITH fields AS (SELECT DISTINCT event_type, key, json_type(props, '$.' || key) AS t FROM (
  SELECT event_type, props, unnest(json_keys(props)) AS key FROM events))
SELECT event_type, n, shape FROM (
  SELECT event_type, 'OBJECT<' || string_agg(key || ': ' || CASE WHEN t IN ('UBIGINT', 'BIGINT') THEN 'BIGINT'
    WHEN t = 'VARCHAR' THEN 'STRING' ELSE t END, ', ' ORDER BY key) || '>' AS shape FROM fields GROUP BY event_type)
JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) USING (event_type)""",
)
def json_schema_report(spark: SparkSession, sf: str) -> DataFrame:
    """The shape that all documents of a type have in common."""
    events = read(spark, sf, "events")
    return events.groupBy("event_type").agg(
        F.count("*").alias("n"), schema_report(parsed("props")).alias("shape")
    )


@query(
    "json_nested_string",
    f"""WITH {b.DOCS} SELECT id, body, first_line AS title, 'handle' || id AS handle
FROM docs WHERE app = 'cyberconnect' AND cycle % 5 <> 0 AND cycle % 13 <> 12"""
)
def json_nested_string(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract_app(b.labelled_payloads(spark, sf), "cyberconnect")
    return rows.select("id", "body", "title", F.col("contributor").alias("handle"))


@query(
    "json_tags",
    f"""WITH {b.DOCS} SELECT id, CASE WHEN cycle % 13 = 12 THEN '' ELSE lang || '|' || source END AS tags,
  CAST(CASE WHEN cycle % 13 = 12 THEN 0 ELSE 2 END AS BIGINT) AS n_tags, '' AS array_as_scalar
FROM docs WHERE app = 'lens'"""
)
def json_tags(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.labelled_payloads(spark, sf).filter(F.col("app").isin("lenster", "hey.xyz"))
    fields = read_once("content", {"tags": ("$.tags", "texts"), "as_scalar": ("$.tags", "text")})
    return computed_once(rows.select("id", "content"), {"_f": fields}).select(
        "id", F.array_join("_f.tags", "|").alias("tags"), F.size("_f.tags").cast("bigint").alias("n_tags"),
        F.col("_f.as_scalar").alias("array_as_scalar"),
    )


@query(
    "json_type_filter",
    f"""WITH {b.DOCS} SELECT id, body FROM docs
WHERE app = 'lens' AND cycle % 7 <> 0 AND cycle % 13 <> 12"""
)
def json_type_filter(spark: SparkSession, sf: str) -> DataFrame:
    return extract_app(b.labelled_payloads(spark, sf), "lens").select("id", "body")


_DEEP_PRESENT = {
    "content": "body",
    "content_timestamp": "CAST(id + 1700000000 AS VARCHAR)",
    "title": "first_line",
    "digest": "sha1(body)",
    "contributor": "'0x' || id",
    "algorithm_name": "'RSA'",
    "algorithm_hash": "'SHA-256'",
    "version_date": "'04-25-2022'",
    "wnft_chain_id": "'10'",
    "wnft_name": "first_line",
    "wnft_supply": "CAST(id AS VARCHAR)",
}


@query(
    "json_deep_projection",
    f"WITH {b.DOCS} SELECT id AS content_id, "
    + ", ".join(f"{_DEEP_PRESENT.get(c, chr(39) * 2)} AS {c}" for c in DEEP_FIELDS)
    + " FROM docs WHERE app = 'mirrorxyz' AND cycle % 13 <> 12"
)
def json_deep_projection(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.labelled_payloads(spark, sf).filter(F.col("app") == "mirrorxyz")
    return deep_projection(rows).filter(F.col("digest") != "")


@query(
    "to_json_columns",
    f"""WITH {b.DOCS}, {b.stats_cte('docs')}
SELECT id, '["' || lang || '","' || source || '"]' AS tags, '{{"lang":"' || lang || '"}}' AS as_map,
  '{{"tokens":' || alpha_token_count || ',"source":"' || source || '"}}' AS as_struct
FROM stats"""
)
def to_json_columns(spark: SparkSession, sf: str) -> DataFrame:
    return text_fn.with_char_stats(b.documents(spark, sf)).select(
        "id",
        F.to_json(F.array("lang", "source")).alias("tags"),
        F.to_json(F.create_map(F.lit("lang"), "lang")).alias("as_map"),
        F.to_json(F.struct(F.col("alpha_token_count").alias("tokens"), "source")).alias("as_struct"),
    )


# ---- unified and quality content ---------------------------------------------------


def _all_content(spark: SparkSession, sf: str) -> DataFrame:
    """One pass over the payloads, stacked with the transcripts."""
    return content_union(
        [
            extract_all(b.labelled_payloads(spark, sf)),
            transcript_content(b.transcripts_table(spark, sf)),
        ]
    )


def content_with_stats(spark: SparkSession, sf: str) -> DataFrame:
    return with_gate_stats(_all_content(spark, sf), b.language_profile(spark, sf))


_FLAT = """SELECT id, created_at, app, body, content_timestamp, title, contributor, tags, retrieved_at"""


@query("content_union", f"WITH {b.EXTRACTED} {_FLAT} FROM extracted")
def content_union_view(spark: SparkSession, sf: str) -> DataFrame:
    """The view as five application frames, as a catalog of per-application tables has it."""
    rows = b.labelled_payloads(spark, sf)
    frames = [extract_app(rows, app) for app in FORMATS]
    frames.append(transcript_content(b.transcripts_table(spark, sf)))
    return content_union(frames).withColumn("tags", F.array_join("tags", ","))



@query("content_single_pass", f"WITH {b.EXTRACTED} {_FLAT} FROM extracted")
def content_single_pass(spark: SparkSession, sf: str) -> DataFrame:
    return _all_content(spark, sf).withColumn("tags", F.array_join("tags", ","))


PIPE = f"""{b.EXTRACTED}, {b.PROFILE}, {b.mix_cte('extracted')}, {b.stats_cte('extracted')},
gated AS (SELECT * FROM stats {b.EN_SHARE} WHERE {b.GATE}), {b.minhash_cte('gated')}"""

_QC_COLUMNS = """id, created_at, app, body, content_timestamp, title, contributor, tags, retrieved_at,
  alpha_token_count, alpha_char_count, total_char_count, non_alpha_char_count,
  round(non_alpha_ratio, 6) AS non_alpha_ratio, round(alpha_ratio, 6) AS alpha_ratio,
  round(en, 6) AS en_share, h1 AS ngram_min_1, h2 AS ngram_min_2"""
KEPT_SIMHASH = _folded_cte(_CHAR_SHINGLES, "(SELECT id, lower(body) AS t FROM kept)")


def _quality_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "created_at", "app", "body", "content_timestamp", "title", "contributor",
        F.array_join("tags", ",").alias("tags"), "retrieved_at", "alpha_token_count",
        "alpha_char_count", "total_char_count", "non_alpha_char_count",
        r6("non_alpha_ratio").alias("non_alpha_ratio"), r6("alpha_ratio").alias("alpha_ratio"),
        r6(F.col("languages")["en"]).alias("en_share"), "ngram_min_1",
        F.col("ngram_min_hash.h2").alias("ngram_min_2"),
        fp.simhash_chars("body").alias("ngram_hash"),
    )


def _quality_sql(condition: str = "TRUE") -> str:
    return f"""WITH {PIPE},
kept AS (SELECT {_QC_COLUMNS} FROM gated JOIN minhash USING (id) WHERE {condition}
  QUALIFY row_number() OVER (PARTITION BY h1 ORDER BY retrieved_at, id) = 1), {KEPT_SIMHASH}
SELECT kept.*, {SIGNED} AS ngram_hash FROM kept LEFT JOIN folded USING (id)"""


@query("quality_content", _quality_sql())
def quality_content_table(spark: SparkSession, sf: str) -> DataFrame:
    return _quality_columns(quality_content(content_with_stats(spark, sf)))



@query("quality_content_app", _quality_sql("app = 'odysee'"))
def quality_content_app(spark: SparkSession, sf: str) -> DataFrame:
    return _quality_columns(quality_content(content_with_stats(spark, sf), "odysee"))


@query(
    "quality_counts_by_app",
    f"""WITH {PIPE}, kept AS (SELECT app FROM gated JOIN minhash USING (id)
  QUALIFY row_number() OVER (PARTITION BY h1 ORDER BY retrieved_at, id) = 1)
SELECT app, before_dedupe, coalesce(after_dedupe, 0) AS after_dedupe
FROM (SELECT app, count(*) AS before_dedupe FROM gated GROUP BY app)
LEFT JOIN (SELECT app, count(*) AS after_dedupe FROM kept GROUP BY app) USING (app)"""
)
def quality_counts_by_app(spark: SparkSession, sf: str) -> DataFrame:
    return counts_by_app(content_with_stats(spark, sf))


@query(
    "strict_case_gate",
    f"""WITH {b.EXTRACTED}, {b.PROFILE}, {b.mix_cte('extracted')}, {b.stats_cte('extracted')},
strict AS (SELECT * FROM stats {b.EN_SHARE}
  WHERE non_alpha_ratio < 0.25 AND CASE WHEN app = 'lens' THEN body NOT ILIKE '%i just voted%' END
    AND CASE WHEN app = 'cyberconnect' THEN alpha_token_count > 300 ELSE alpha_token_count > 30 END
    AND coalesce(en, 0) > 0.9), {b.minhash_cte('strict')}
SELECT count(*) AS n_rows, count(DISTINCT h1) AS n_keys FROM minhash"""
)
def strict_case_gate(spark: SparkSession, sf: str) -> DataFrame:
    rows = content_with_stats(spark, sf).filter(strict_quality_gate())
    return rows.select(F.col("ngram_min_hash.h1").alias("h1")).agg(
        F.count("*").alias("n_rows"), F.countDistinct("h1").alias("n_keys")
    )


@query(
    "filtered_count",
    f"""WITH {b.EXTRACTED}, {b.stats_cte('extracted')} SELECT count(*) AS n FROM stats
WHERE app = 'lens' AND alpha_token_count > 30 AND body NOT ILIKE '%i just voted%'"""
)
def filtered_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = text_fn.with_char_stats(_all_content(spark, sf).filter(F.col("app") == "lens"))
    return rows.filter(
        (F.col("alpha_token_count") > 30) & ~F.col("body").ilike("%i just voted%")
    ).agg(F.count("*").alias("n"))


# ---- duplicate audit and topic search ------------------------------------------------


@query(
    "dup_audit",
    f"""WITH {b.DOCS}, {b.minhash_cte('docs')}
SELECT count(*) AS n_rows, count(DISTINCT upper(sha1(body))) AS distinct_sha1,
  count(DISTINCT h1) AS distinct_min_1, count(DISTINCT (h1, h2)) AS distinct_pair
FROM docs JOIN minhash USING (id)"""
)
def dup_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.documents(spark, sf).select(
        fp.sha1_hex("body").alias("sha1"), fp.minhash_pair("body").alias("m")
    )
    return analytics.distinct_counts(
        rows, {"sha1": "sha1", "min_1": "m.h1", "pair": "m"}
    )


_CLUSTERS = f"""{b.DOCS}, {b.minhash_cte('docs')},
clusters AS (SELECT h1, h2, count(*) AS n, CAST(max(strlen(body)) AS BIGINT) AS longest
  FROM docs JOIN minhash USING (id) GROUP BY h1, h2)"""


def _fingerprinted(spark: SparkSession, sf: str) -> DataFrame:
    return b.documents(spark, sf).select(
        "id", "body", fp.minhash_pair("body").alias("ngram_hash")
    )


@query("dup_clusters", f"WITH {_CLUSTERS} SELECT h1, h2, n, longest FROM clusters")
def dup_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.duplicate_clusters(_fingerprinted(spark, sf), "ngram_hash", "body").select(
        "ngram_hash.h1", "ngram_hash.h2", "n", "longest"
    )


@query(
    "dup_cluster_members",
    f"""WITH {_CLUSTERS}, top AS (SELECT h1, h2 FROM clusters ORDER BY n DESC, h1 LIMIT 1)
SELECT id, body FROM docs JOIN minhash USING (id) JOIN top USING (h1, h2)"""
)
def dup_cluster_members(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of the largest cluster. The key of the cluster is one row, so its values are
    scalar subqueries inside the filter."""
    rows = _fingerprinted(spark, sf)
    key = (
        analytics.duplicate_clusters(rows, "ngram_hash", "body")
        .orderBy(F.desc("n"), F.col("ngram_hash.h1"))
        .limit(1)
    )
    return rows.filter(
        (F.col("ngram_hash.h1") == key.select("ngram_hash.h1").scalar())
        & (F.col("ngram_hash.h2") == key.select("ngram_hash.h2").scalar())
    ).select("id", "body")


_TERMS = ("tion", "ement")


def _search_sql(condition: str) -> str:
    return f"""SELECT doc_id AS id, matches, upper(sha1(text)) AS sha1 FROM (
  SELECT *, concat_ws(',', CASE WHEN contains(text, 'tion') THEN '1' END,
    CASE WHEN contains(text, 'ement') THEN '2' END) AS matches FROM documents)
WHERE {condition}"""


def _search(spark: SparkSession, sf: str, match_all: bool) -> DataFrame:
    found = analytics.topic_search(b.documents(spark, sf), "body", _TERMS, match_all)
    return found.select(
        "id", F.array_join(F.col("matches").cast("array<string>"), ",").alias("matches"),
        fp.sha1_hex("body").alias("sha1"),
    )


@query("keyword_match_all", _search_sql("matches = '1,2'"))
def keyword_match_all(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf, match_all=True)


@query("keyword_match_any", _search_sql("matches <> '' AND strlen(text) > 100"))
def keyword_match_any(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.documents(spark, sf).filter(F.octet_length("body") > 100)
    found = analytics.topic_search(rows, "body", _TERMS, match_all=False)
    return found.select(
        "id", F.array_join(F.col("matches").cast("array<string>"), ",").alias("matches"),
        fp.sha1_hex("body").alias("sha1"),
    )


def _substring_index(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_table(spark, "trigrams")
    substrings.write_substring_index(b.documents(spark, sf), table, buckets=32)
    return spark.table(table)


@query("keyword_match_all_indexed", _search_sql("matches = '1,2'"))
def keyword_match_all_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """``keyword_match_all`` on the candidates of a stored trigram index."""
    docs = b.documents(spark, sf)
    few = substrings.candidates(docs, _substring_index(spark, sf), _TERMS, True, buckets=32)
    found = analytics.topic_search(few, "body", _TERMS, match_all=True)
    return found.select(
        "id", F.array_join(F.col("matches").cast("array<string>"), ",").alias("matches"),
        fp.sha1_hex("body").alias("sha1"),
    )


_NEEDLES = ("THREAFORT", "Chapter", "license", "e-mail", "@example.")


@query(
    "multi_substring_indexed",
    "SELECT doc_id AS id, lang FROM documents WHERE " + " OR ".join(f"text ILIKE '%{n}%'" for n in _NEEDLES),
)
def multi_substring_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with any of several rare substrings, in whatever case, from the index."""
    found = substrings.containing(b.documents(spark, sf), _substring_index(spark, sf), _NEEDLES, False, buckets=32)
    return found.select("id", "lang")


@query(
    "keyword_match_ranked",
    f"""WITH {b.DOCS}, {b.stats_cte('docs')} SELECT id, alpha_token_count FROM stats
WHERE contains(body, 'tion') AND contains(body, 'ing') ORDER BY alpha_token_count DESC, id LIMIT 50"""
)
def keyword_match_ranked(spark: SparkSession, sf: str) -> DataFrame:
    rows = text_fn.with_char_stats(b.documents(spark, sf))
    found = rows.withColumn("matches", matching_patterns("body", ("tion", "ing")))
    return (
        found.filter(F.size("matches") == 2)
        .orderBy(F.desc("alpha_token_count"), "id")
        .select("id", "alpha_token_count")
        .limit(50)
    )
