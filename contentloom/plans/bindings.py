"""The given tables in the shapes the operators work on.

Spark side and SQL side of each binding stand next to each other, so that the oracle
reads plain columns where the engine reads the JSON it has to parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contentloom.functions.language import Profile, collect_profile, profile_table
from contentloom.sources.tables import read

APPS = ("paragraph", "lens", "mirrorxyz", "cyberconnect", "odysee")


def _source_number() -> Column:
    return F.substring("source", 4, 10).cast("int")


def _given_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The given documents. A test table is one file of one row group, which no reader can
    split; only such a table is dealt to the cores here, by the binding and not by the library."""
    df = read(spark, sf, "documents")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) == 1 else df


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """id, body, lang, source, app, created_at, created_at_dt, retrieved_at, cycle, n_chars."""
    d = _given_texts(spark, sf)
    app = F.element_at(
        F.array(*[F.lit(a) for a in APPS]), (_source_number() % len(APPS)) + 1
    )
    created = F.expr("timestamp_ntz'2023-01-01 00:00:00' + make_dt_interval(0, 0, doc_id)")
    retrieved = F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id)"
    )
    return d.select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("body"),
        "lang",
        "source",
        app.alias("app"),
        created.alias("created_at"),
        F.date_trunc("day", created).cast("timestamp_ntz").alias("created_at_dt"),
        retrieved.alias("retrieved_at"),
        F.floor(F.col("doc_id") / 20).cast("bigint").alias("cycle"),
        "n_chars",
    )


DOCS = """docs AS (
  SELECT doc_id AS id, text AS body, lang, source,
    list_extract(['paragraph','lens','mirrorxyz','cyberconnect','odysee'],
                 CAST(substr(source, 4) AS INTEGER) % 5 + 1) AS app,
    TIMESTAMP '2023-01-01 00:00:00' + to_minutes(doc_id) AS created_at,
    date_trunc('day', TIMESTAMP '2023-01-01 00:00:00' + to_minutes(doc_id)) AS created_at_dt,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS retrieved_at,
    doc_id // 20 AS cycle, n_chars,
    split_part(text, chr(10), 1) AS first_line
  FROM documents)"""


def _envelope() -> Column:
    """The payload of each application as the JSON its users write."""
    text, title = F.col("body"), F.substring_index("body", "\n", 1)
    stamp = (F.col("id") + 1700000000).cast("string")
    who = F.concat(F.lit("0x"), F.col("id"))
    mirror = F.struct(
        F.struct(text.alias("body"), stamp.alias("timestamp"), title.alias("title")).alias("content"),
        F.sha1(text.cast("binary")).alias("digest"),
        F.struct(
            who.alias("contributor"),
            F.struct(F.lit("RSA").alias("name"), F.lit("SHA-256").alias("hash")).alias("algorithm"),
        ).alias("authorship"),
        F.lit("04-25-2022").alias("version"),
        F.struct(
            F.lit(10).alias("chainId"), title.alias("name"), F.col("id").alias("supply"),
        ).alias("wnft"),
    )
    lens = F.struct(
        text.alias("content"),
        stamp.alias("createdOn"),
        title.alias("name"),
        F.concat(F.lit("https://example.org/"), F.col("id")).alias("external_url"),
        F.array("lang", "source").alias("tags"),
        F.when(F.col("cycle") % 7 == 0, "VIDEO").otherwise("TEXT_ONLY").alias("mainContentFocus"),
    )
    paragraph = F.struct(
        text.alias("markdown"),
        stamp.alias("publishedAt"),
        title.alias("title"),
        F.array(who, F.lit("second")).alias("authors"),
        F.array("source").alias("categories"),
    )
    inner = F.struct(
        F.when(F.col("cycle") % 5 == 0, "like").otherwise("post").alias("op"),
        text.alias("body"),
        stamp.alias("ts"),
        title.alias("title"),
        F.concat(F.lit("handle"), F.col("id")).alias("handle"),
        who.alias("author"),
    )
    cyber = F.struct(F.to_json(inner).alias("content"))
    return (
        F.when(F.col("app") == "mirrorxyz", F.to_json(mirror))
        .when(F.col("app") == "lens", F.to_json(lens))
        .when(F.col("app") == "paragraph", F.to_json(paragraph))
        .when(F.col("app") == "cyberconnect", F.to_json(cyber))
    )


def payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Raw payload cache: JSON of four applications; every 13th cycle is cut off, hence
    malformed."""
    raw = F.when(
        F.col("cycle") % 13 == 12, F.expr("left(_json, char_length(_json) - 2)")
    ).otherwise(F.col("_json"))
    return (
        documents(spark, sf)
        .filter(F.col("app") != "odysee")
        .withColumn("_json", _envelope())
        .select(
            "id", "created_at", "created_at_dt", "retrieved_at", raw.alias("content")
        )
    )


def index(spark: SparkSession, sf: str) -> DataFrame:
    """Index rows; lens items carry one of the two labels of their clients."""
    label = F.when(
        F.col("app") == "lens",
        F.when(F.col("id") % 2 == 0, "lenster").otherwise("hey.xyz"),
    ).otherwise(F.col("app"))
    return documents(spark, sf).select(
        "id", "created_at", "created_at_dt", F.col("n_chars").alias("data_size"),
        label.alias("app"),
    )


def labelled_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Payload cache joined to its index row."""
    idx = index(spark, sf).select("id", "app")
    return payloads(spark, sf).join(idx, "id")


def transcripts_table(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the transcript application as transcript rows."""
    return documents(spark, sf).filter(F.col("app") == "odysee").select(
        F.col("id").alias("source_url"),
        F.col("body").alias("fulltext"),
        F.col("created_at"),
    )


# What the extraction must give: malformed payloads have no fields, and the two
# applications with a required field lose those payloads altogether.
EXTRACTED = (
    DOCS
    + """, extracted AS (
  SELECT id, created_at, app,
    CASE WHEN bad THEN '' ELSE body END AS body,
    CASE WHEN bad OR app = 'odysee' THEN '' ELSE CAST(id + 1700000000 AS VARCHAR) END AS content_timestamp,
    CASE WHEN bad OR app = 'odysee' THEN '' ELSE first_line END AS title,
    CASE WHEN bad OR app = 'odysee' THEN ''
         WHEN app = 'lens' THEN 'https://example.org/' || id
         WHEN app = 'cyberconnect' THEN 'handle' || id
         ELSE '0x' || id END AS contributor,
    CASE WHEN bad THEN '' WHEN app = 'lens' THEN lang || ',' || source
         WHEN app = 'paragraph' THEN source ELSE '' END AS tags,
    CASE WHEN app = 'odysee' THEN created_at ELSE retrieved_at END AS retrieved_at
  FROM (SELECT *, app <> 'odysee' AND cycle % 13 = 12 AS bad FROM docs)
  WHERE NOT (app = 'lens' AND (bad OR cycle % 7 = 0))
    AND NOT (app = 'cyberconnect' AND (bad OR cycle % 5 = 0)))"""
)


def language_profile(spark: SparkSession, sf: str) -> Profile:
    return collect_profile(profile_table(_given_texts(spark, sf), "text", "lang"))


# Word list of a text column, and the profile made of the labelled documents.
def sql_words(column: str) -> str:
    return (
        f"list_filter(string_split(trim(regexp_replace(lower({column}), '[^\\p{{L}}]+', ' ', 'g')), ' '), "
        "lambda w: w <> '')"
    )


PROFILE = f"""profile AS (
  WITH tokens AS (SELECT lang, unnest({sql_words('text')}) AS token FROM documents),
  ranked AS (
    SELECT lang, token, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, token) AS rank
    FROM tokens GROUP BY lang, token)
  SELECT token, min(lang) AS lang FROM ranked WHERE rank <= 40
  GROUP BY token HAVING count(*) = 1)"""


def mix_cte(source: str) -> str:
    """CTE ``mix(id, lang, share, pos)``: the languages of each text, strongest first."""
    return f"""mix AS (
  WITH tokens AS (SELECT id, unnest({sql_words('body')}) AS token FROM {source}),
  hits AS (SELECT id, lang, count(*) AS n FROM tokens JOIN profile USING (token) GROUP BY id, lang)
  SELECT id, lang, n / sum(n) OVER (PARTITION BY id) AS share,
    row_number() OVER (PARTITION BY id ORDER BY n DESC, lang) AS pos
  FROM hits)"""


def stats_cte(source: str, name: str = "stats") -> str:
    return f"""{name} AS (
  SELECT *, total_char_count - alpha_char_count AS non_alpha_char_count,
    CASE WHEN total_char_count > 0
         THEN (total_char_count - alpha_char_count) / total_char_count END AS non_alpha_ratio,
    CASE WHEN total_char_count > 0 THEN alpha_char_count / total_char_count END AS alpha_ratio
  FROM (SELECT *,
    CAST(len(regexp_extract_all(body, '[A-Za-z]+')) AS BIGINT) AS alpha_token_count,
    CAST(length(regexp_replace(body, '[^A-Za-z]', '', 'g')) AS BIGINT) AS alpha_char_count,
    CAST(strlen(body) AS BIGINT) AS total_char_count
    FROM {source}))"""


def sql_hash64(text: str) -> str:
    """First 64 bits of md5 as a signed number."""
    u = f"CAST(('0x' || substr(md5({text}), 1, 16)) AS UBIGINT)"
    return (
        f"CAST(CAST({u} AS HUGEINT) - CASE WHEN {u} >= 9223372036854775808 "
        "THEN 18446744073709551616 ELSE 0 END AS BIGINT)"
    )


def minhash_cte(source: str) -> str:
    """CTE ``minhash(id, h1, h2)``."""
    return f"""minhash AS (
  SELECT id, {sql_hash64("array_to_string(hs[1:6], ',')")} AS h1,
    {sql_hash64("array_to_string(list_reverse(hs)[1:6], ',')")} AS h2
  FROM (SELECT id, list_sort(list_transform(list_distinct(
      list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))), lambda s: md5(s))) AS hs
    FROM (SELECT id, lower(body) AS t FROM {source})))"""


GATE = """non_alpha_ratio < 0.25 AND alpha_token_count > 30 AND coalesce(en, 0) > 0.9
  AND CASE WHEN app = 'lens' THEN body NOT ILIKE '%i just voted%'
           WHEN app = 'cyberconnect' THEN alpha_token_count > 300 ELSE TRUE END"""
EN_SHARE = "LEFT JOIN (SELECT id, share AS en FROM mix WHERE lang = 'en') USING (id)"
