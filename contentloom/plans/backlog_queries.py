"""Joins to the index, backlogs, work lists, endpoints and block records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contentloom.functions.core import contains_any_ignore_case
from contentloom.operators import analytics, backlog as bl
from contentloom.operators.keyed import batch_plan, first_per_key, latest_per_key
from contentloom.plans import bindings as b
from contentloom.plans.registry import Family
from contentloom.sources import blocks as blk
from contentloom.session import cut_lineage, scratch_table
from contentloom.sources.tables import read, write_bucketed

FAMILY = Family()
query = FAMILY.query


# ---- joins -------------------------------------------------------------------------


@query(
    "inner_join_index",
    """SELECT l_orderkey, l_linenumber, o_orderstatus, o_custkey
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def inner_join_index(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_custkey"
    )
    items = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return items.join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "o_orderstatus", "o_custkey"
    )


@query(
    "composite_join",
    f"""WITH {b.DOCS} SELECT id, created_at_dt, retrieved_at, n_chars AS data_size,
  CASE WHEN app = 'lens' THEN CASE WHEN id % 2 = 0 THEN 'lenster' ELSE 'hey.xyz' END ELSE app END AS app
FROM docs WHERE app IN ('paragraph', 'lens', 'mirrorxyz', 'cyberconnect')""",
)
def composite_join(spark: SparkSession, sf: str) -> DataFrame:
    cache = b.payloads(spark, sf).select("id", "created_at_dt", "retrieved_at")
    return cache.join(b.index(spark, sf).drop("created_at"), ["created_at_dt", "id"]).select(
        "id", "created_at_dt", "retrieved_at", "data_size", "app"
    )


@query(
    "bucketed_join",
    """SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def bucketed_join(spark: SparkSession, sf: str) -> DataFrame:
    """Both tables stored in buckets of the join key: the join itself shuffles nothing."""
    orders, items = scratch_table(spark, "orders"), scratch_table(spark, "items")
    write_bucketed(
        read(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey"), orders, ["k"], 8
    )
    write_bucketed(
        read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber"),
        items, ["k"], 8,
    )
    joined = spark.table(items).join(spark.table(orders), "k")
    return joined.select(F.col("k").alias("l_orderkey"), "l_linenumber", "o_custkey")


# ---- backlog -----------------------------------------------------------------------


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "labels").withColumnRenamed("doc_id", "id")


@query(
    "backlog_anti",
    f"""WITH {b.DOCS} SELECT id, created_at, created_at_dt FROM docs
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = id)""",
)
def backlog_anti(spark: SparkSession, sf: str) -> DataFrame:
    source = b.documents(spark, sf).select("id", "created_at", "created_at_dt")
    return bl.not_done(source, _labels(spark, sf), ["id"])


@query(
    "backlog_left_null",
    f"""WITH {b.DOCS}, files AS (
  SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'text' ELSE '' END AS content FROM labels)
SELECT docs.id, app FROM docs LEFT JOIN files USING (id)
WHERE files.content IS NULL OR files.content = ''""",
)
def backlog_left_null(spark: SparkSession, sf: str) -> DataFrame:
    content = F.when(F.col("quality") == 1, "text").otherwise("")
    files = _labels(spark, sf).select("id", content.alias("content"))
    source = b.documents(spark, sf).select("id", "app")
    return bl.missing_partner(source, files, "id", "content")


_STAGES = ("spacy", "flair", "bart_categories", "keybert_keywords")
_FLAGS = f"""{b.DOCS}, flagged AS (
  SELECT id, app,
    CAST(EXISTS (SELECT 1 FROM labels WHERE doc_id = id AND quality = 1) AS INTEGER) AS has_spacy,
    CAST(EXISTS (SELECT 1 FROM labels WHERE doc_id = id AND toxic = 0) AS INTEGER) AS has_flair,
    CAST(EXISTS (SELECT 1 FROM conversations WHERE conv_id = id) AS INTEGER) AS has_bart_categories,
    CAST(EXISTS (SELECT 1 FROM embeddings WHERE vec_id = id) AS INTEGER) AS has_keybert_keywords
  FROM docs)"""


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    labels = _labels(spark, sf)
    stages = {
        "spacy": labels.filter("quality = 1"),
        "flair": labels.filter("toxic = 0"),
        "bart_categories": read(spark, sf, "conversations").withColumnRenamed("conv_id", "id"),
        "keybert_keywords": read(spark, sf, "embeddings").withColumnRenamed("vec_id", "id"),
    }
    return bl.stage_flags(b.documents(spark, sf).select("id", "app"), stages)


@query(
    "stage_flags",
    f"""WITH {_FLAGS} SELECT id, app, has_spacy, has_flair, has_bart_categories, has_keybert_keywords
FROM flagged""",
)
def stage_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged(spark, sf)


@query(
    "stage_pending",
    f"""WITH {_FLAGS} SELECT id, concat_ws(',',
  CASE WHEN has_spacy = 0 THEN 'spacy' END, CASE WHEN has_flair = 0 THEN 'flair' END,
  CASE WHEN has_bart_categories = 0 THEN 'bart_categories' END,
  CASE WHEN has_keybert_keywords = 0 THEN 'keybert_keywords' END) AS pending
FROM flagged WHERE least(has_spacy, has_flair, has_bart_categories, has_keybert_keywords) = 0""",
)
def stage_pending(spark: SparkSession, sf: str) -> DataFrame:
    open_rows = bl.any_pending(_flagged(spark, sf), _STAGES)
    marks = [F.when(F.col(f"has_{s}") == 0, s) for s in _STAGES]
    return open_rows.select("id", F.concat_ws(",", *marks).alias("pending"))


@query(
    "stage_pending_counts",
    f"""WITH {_FLAGS}, open AS (SELECT * FROM flagged
  WHERE least(has_spacy, has_flair, has_bart_categories, has_keybert_keywords) = 0)
SELECT 'spacy' AS stage, count(*) AS n FROM open WHERE has_spacy = 0
UNION ALL SELECT 'flair', count(*) FROM open WHERE has_flair = 0
UNION ALL SELECT 'bart_categories', count(*) FROM open WHERE has_bart_categories = 0
UNION ALL SELECT 'keybert_keywords', count(*) FROM open WHERE has_keybert_keywords = 0""",
)
def stage_pending_counts(spark: SparkSession, sf: str) -> DataFrame:
    """All four stage portions from one pass over the flags."""
    open_rows = bl.any_pending(_flagged(spark, sf), _STAGES)
    counts = open_rows.agg(*[F.count_if(F.col(f"has_{s}") == 0).alias(s) for s in _STAGES])
    return counts.unpivot([], list(_STAGES), "stage", "n")


@query(
    "random_backlog",
    """SELECT least(100, count(*)) AS n_rows, least(100, count(*)) AS n_ids, CAST(0 AS BIGINT) AS n_done
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def random_backlog(spark: SparkSession, sf: str) -> DataFrame:
    """A random portion of the backlog, one row per id, differs from run to run: its size,
    its ids and that all of them are pending do not."""
    portion = bl.backlog(
        b.documents(spark, sf).select("id", "retrieved_at", "created_at"),
        _labels(spark, sf), ["id"], limit=100, distinct_on="id", order=["retrieved_at"],
    )
    done = _labels(spark, sf).select("id").distinct().withColumn("done", F.lit(1))
    return portion.join(done, "id", "left").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.count("done").alias("n_done"),
    )


@query(
    "hash_ordered_backlog",
    f"""WITH {b.DOCS} SELECT id, created_at FROM docs
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = id)
ORDER BY md5('s1' || id), id LIMIT 100""",
)
def hash_ordered_backlog(spark: SparkSession, sf: str) -> DataFrame:
    source = b.documents(spark, sf).select("id", "created_at")
    todo = bl.not_done(source, _labels(spark, sf), ["id"])
    return bl.hash_ordered_subset(todo, "id", 100, seed="s1")


@query(
    "hash_sample",
    """WITH n AS (SELECT count(*) AS total FROM orders)
SELECT o_orderkey, o_custkey FROM orders, n
WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) AS INTEGER)
  < least(65536, (65536 * 1000 + total - 1) // total)""",
)
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return bl.md5_sample(orders, "o_orderkey", about=1000, total=orders.count())


@query(
    "hash_sample_native",
    "SELECT count(*) AS n_rows, TRUE AS subset, TRUE AS near_share FROM orders",
)
def hash_sample_native(spark: SparkSession, sf: str) -> DataFrame:
    """The same with Spark's own 64-bit hash, which no other engine computes: the sample is
    part of the table, has no row twice and about the size asked for."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    total = orders.count()
    about = min(1000, total)
    sample = bl.hash_sample(orders, "o_orderkey", about=about, total=total)
    taken = sample.groupBy("o_orderkey").agg(F.count("*").alias("taken"))
    both = orders.join(taken, "o_orderkey", "full")
    return both.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.max("taken") == 1, F.lit(False)).alias("subset"),
        (F.abs(F.sum("taken") - about) <= 5 * about**0.5 + 1).alias("near_share"),
    )


@query(
    "missing_heights",
    """SELECT range AS height FROM range(0, (SELECT max(l_orderkey) + 1 FROM lineitem))
WHERE range NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def missing_heights(spark: SparkSession, sf: str) -> DataFrame:
    stored = read(spark, sf, "lineitem").select("l_orderkey")
    upper = (stored.agg(F.max("l_orderkey")).first()[0] or -1) + 1
    return bl.missing_heights(spark, stored, upper, "l_orderkey")


@query(
    "batch_plan",
    """SELECT o_orderkey, i // 200 AS batch_id FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)""",
)
def batch_plan_query(spark: SparkSession, sf: str) -> DataFrame:
    return batch_plan(read(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 200)


# ---- incremental loads -----------------------------------------------------------------

_SPLIT = "2024-01-20 00:00:00"


def _event_halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = read(spark, sf, "events").select("event_id", "ts", "event_type")
    return events, events.filter(F.col("ts") < F.lit(_SPLIT).cast("timestamp_ntz"))


@query(
    "incremental_since_max",
    f"""SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS created_at_dt, event_type FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{_SPLIT}')
  AND (contains(lower(event_type), 'click') OR event_type IN ('purchase', 'signup'))""",
)
def incremental_since_max(spark: SparkSession, sf: str) -> DataFrame:
    source, target = _event_halves(spark, sf)
    wanted = contains_any_ignore_case("event_type", ["CLICK"]) | F.col("event_type").isin(
        "purchase", "signup"
    )
    fresh = bl.newer_than_max(source, target, "ts", wanted)
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return fresh.select("event_id", day.alias("created_at_dt"), "event_type")


@query(
    "incremental_unbracketed",
    f"""SELECT event_id, event_type FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{_SPLIT}')
  AND contains(lower(event_type), 'click') OR event_type IN ('purchase', 'signup')""",
)
def incremental_unbracketed(spark: SparkSession, sf: str) -> DataFrame:
    source, target = _event_halves(spark, sf)
    return bl.newer_than_max_or_listed(
        source, target, "ts",
        contains_any_ignore_case("event_type", ["CLICK"]),
        F.col("event_type").isin("purchase", "signup"),
    ).select("event_id", "event_type")


@query(
    "newest_created_at",
    """SELECT max(ts) AS created_at FROM events
WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)""",
)
def newest_created_at(spark: SparkSession, sf: str) -> DataFrame:
    """Newest row of the newest day, as one value."""
    return read(spark, sf, "events").agg(
        F.max_by("ts", F.struct(F.date_trunc("day", "ts"), "ts")).alias("created_at")
    )


# ---- endpoints and downloads ------------------------------------------------------------

_BASE = ", ".join(f"('{u}')" for u in blk.BASE_ENDPOINTS)
_ENDPOINTS = f"""endpoints AS (
  SELECT DISTINCT endpoint FROM (
    SELECT 'https://' || regexp_extract(url, '://([^/]*)/', 1) || '/' AS endpoint FROM pages
    UNION ALL SELECT * FROM (VALUES {_BASE})))"""


def _endpoints(spark: SparkSession, sf: str) -> DataFrame:
    host = F.regexp_extract("url", "://([^/]*)/", 1)
    entry = F.struct(
        F.struct(F.lit("https").alias("protocol"), host.alias("fqdn")).alias("settings")
    )
    registry = read(spark, sf, "pages").select(
        F.to_json(
            F.struct(F.create_map(F.col("page_id").cast("string"), entry).alias("gateways"))
        ).alias("registry")
    )
    return blk.endpoint_list(blk.registry_endpoints(registry, "registry"))


@query("endpoint_list", f"WITH {_ENDPOINTS} SELECT endpoint FROM endpoints")
def endpoint_list(spark: SparkSession, sf: str) -> DataFrame:
    return _endpoints(spark, sf)


@query(
    "endpoint_assignment",
    f"""WITH {_ENDPOINTS}, slots AS (
  SELECT endpoint, row_number() OVER (ORDER BY {b.sql_hash64('endpoint')}) - 1 AS slot FROM endpoints),
work AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT o_orderkey, endpoint FROM work JOIN slots ON slot = i % (SELECT count(*) FROM endpoints)""",
)
def endpoint_assignment(spark: SparkSession, sf: str) -> DataFrame:
    work = read(spark, sf, "orders").select("o_orderkey")
    return blk.assign_round_robin(work, "o_orderkey", _endpoints(spark, sf)).select(
        "o_orderkey", "endpoint"
    )


@query(
    "failure_gate",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'""",
)
def failure_gate(spark: SparkSession, sf: str) -> DataFrame:
    downloads = read(spark, sf, "orders").withColumn(
        "created_date", F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate"))
    )
    return analytics.keep_successes_or_fail(downloads, blk.is_downloaded()).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "download_tally",
    """SELECT count(*) AS total, count(*) FILTER (o_orderstatus <> 'F') AS succeeded,
  count(*) FILTER (o_orderstatus = 'F') AS failed FROM orders""",
)
def download_tally(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.outcome_tally(read(spark, sf, "orders"), F.col("o_orderstatus") != "F")


# ---- blocks -----------------------------------------------------------------------------


def _block_text(height, stamp) -> F.Column:
    return F.to_json(F.struct(height.cast("int").alias("height"), stamp.alias("timestamp")))


@query(
    "block_parse",
    """SELECT CAST(event_id AS INTEGER) AS height,
  make_timestamp((1700000000 + event_id * 120) * 1000000) AS block_timestamp,
  '{"height":' || event_id || ',"timestamp":' || (1700000000 + event_id * 120) || '}' AS data_raw,
  '{"height":' || event_id || ',"timestamp":' || (1700000000 + event_id * 120) || '}' AS data_raw_str
FROM events WHERE event_id % 7 <> 3 AND event_id % 11 <> 5""",
)
def block_parse(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    stamp = F.when(e % 11 != 5, e * 120 + 1700000000)
    whole = _block_text(e, stamp)
    raw = read(spark, sf, "events").select(
        F.when(e % 7 == 3, F.substring(whole, 1, 6)).otherwise(whole).alias("response_str")
    )
    return blk.parse_blocks(raw).select(
        "height", F.col("block_timestamp").cast("timestamp_ntz").alias("block_timestamp"),
        F.to_json("data_raw").alias("data_raw"), "data_raw_str",
    )


@query(
    "block_backfill",
    """WITH gaps AS (SELECT range AS height FROM range(0, (SELECT max(l_orderkey) + 1 FROM lineitem))
  WHERE range NOT IN (SELECT l_orderkey FROM lineitem)),
numbered AS (SELECT height, row_number() OVER (ORDER BY height) - 1 AS i FROM gaps)
SELECT CAST(height AS INTEGER) AS height, i // 200 AS batch_id,
  make_timestamp((1700000000 + height * 120) * 1000000) AS block_timestamp FROM numbered
WHERE height % 10 <> 9
UNION ALL SELECT DISTINCT CAST(l_orderkey AS INTEGER), NULL,
  make_timestamp((1600000000 + l_orderkey * 120) * 1000000) FROM lineitem""",
)
def block_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps, batches, fetched records (every tenth is malformed), gate, parse, load."""
    stored = read(spark, sf, "lineitem").select("l_orderkey")
    upper = (stored.agg(F.max("l_orderkey")).first()[0] or -1) + 1
    gaps = bl.missing_heights(spark, stored, upper, "l_orderkey")
    work = cut_lineage(batch_plan(gaps, "height", 200))
    h = F.col("height")
    text = _block_text(h, h * 120 + 1700000000)
    fetched = work.select(
        "batch_id", h.alias("file_id"),
        F.when(h % 10 == 9, F.substring(text, 1, 8)).otherwise(text).alias("response_str"),
    )
    kept = analytics.keep_successes_or_fail(fetched, F.col("response_str").isNotNull())
    parsed = blk.parse_blocks(kept).select("height", "block_timestamp", "inserted_at")
    plan = work.select(F.col("height").cast("int").alias("height"), "batch_id")
    old = stored.distinct().select(
        F.col("l_orderkey").cast("int").alias("height"),
        F.lit(None).cast("bigint").alias("batch_id"),
        F.timestamp_seconds(F.col("l_orderkey") * 120 + 1600000000).alias("block_timestamp"),
        F.lit("2020-01-01").cast("timestamp").alias("inserted_at"),
    )
    merged = latest_per_key(
        old.unionByName(parsed.join(plan, "height")), ["height"], ["inserted_at"]
    )
    return merged.select(
        "height", "batch_id",
        F.col("block_timestamp").cast("timestamp_ntz").alias("block_timestamp"),
    )


@query(
    "first_per_id",
    """SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def first_per_id(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return first_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")
