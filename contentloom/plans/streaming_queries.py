"""The incremental views as streams over the given files, run until all input is read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from contentloom.functions.text import with_char_stats
from contentloom.plans import bindings as b
from contentloom.plans.registry import Family
from contentloom.session import cut_lineage, scratch_path, scratch_table
from contentloom.sources import tables as tb
from contentloom.sources.payloads import transcript_content
from contentloom.streaming import views

FAMILY = Family()
query = FAMILY.query


def _stream(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """The files of a table, which is one file or a folder of files."""
    rows = tb.read(spark, sf, table)
    name = f"{table}.parquet"
    if any(f.rsplit("/", 2)[-2] == name for f in rows.inputFiles()):
        return views.file_stream(spark, f"{sf}/{name}", rows.schema)
    return views.file_stream(spark, sf, rows.schema, name_pattern=name)


@query(
    "stream_tracker",
    f"""WITH {b.DOCS} SELECT id, created_at_dt, created_at, retrieved_at, n_chars AS data_size,
  CASE WHEN app = 'lens' THEN CASE WHEN id % 2 = 0 THEN 'lenster' ELSE 'hey.xyz' END ELSE app END AS app
FROM docs""",
)
def stream_tracker(spark: SparkSession, sf: str) -> DataFrame:
    """Newly cached payloads joined to the index."""
    retrieved = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id)")
    cache = _stream(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), retrieved.alias("retrieved_at")
    )
    return views.materialize(views.tracker(cache, b.index(spark, sf)), "tracker")


@query(
    "stream_transcripts",
    f"""WITH t AS (SELECT conv_id * 1000 + turn AS id, text AS body FROM conversations), {b.stats_cte('t')}
SELECT id, body, '' AS title, '' AS contributor, 'odysee' AS app, alpha_token_count, total_char_count,
  round(non_alpha_ratio, 6) AS non_alpha_ratio FROM stats""",
)
def stream_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """The batch transform of transcripts, applied to newly inserted transcripts."""
    def transform(rows: DataFrame) -> DataFrame:
        content = transcript_content(rows)
        return with_char_stats(content).select(
            "id", "body", "title", "contributor", "app", "alpha_token_count",
            "total_char_count", F.round("non_alpha_ratio", 6).alias("non_alpha_ratio"),
        )

    inserted = _stream(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("source_url"),
        F.col("text").alias("fulltext"),
        F.lit("2024-01-01").cast("timestamp").alias("created_at"),
    )
    return views.materialize(views.transformed(inserted, transform), "transcripts")


@query(
    "stream_dedupe",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """First row per (user, type) within the delay."""
    events = _stream(spark, sf, "events").select("user_id", "event_type", "ts")
    first = views.first_seen(events, ["user_id", "event_type"], "ts", "60 days")
    return views.materialize(first.select("user_id", "event_type"), "first-seen")


@query(
    "stream_latest",
    """SELECT user_id, event_id, event_type, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Newest row per user, kept in a table partitioned by the key's hash: a micro-batch
    rewrites the partitions of its keys only."""
    part = F.pmod(F.xxhash64("user_id"), F.lit(16)).cast("int").alias("part")
    events = _stream(spark, sf, "events").select("user_id", "event_id", "event_type", "ts", part)
    table = scratch_table(spark, "latest")
    empty = spark.createDataFrame([], events.schema)
    empty.write.format("parquet").partitionBy("part").saveAsTable(table)
    keys, order = ["part", "user_id"], ["ts", "event_id"]
    views.keyed_replace_stream(
        events, keys, order,
        lambda batch: tb.keyed_replace_partitions(batch, table, keys, order, "part"),
        scratch_path(spark, "latest-checkpoint"),
    )
    return spark.table(table).drop("part")


@query(
    "stream_daily",
    """SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) GROUP BY 1, 2""",
)
def stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Days that the watermark has closed; the last day stays open in the state."""
    events = _stream(spark, sf, "events").select("ts", "user_id", "event_type")
    days = views.daily_counts(events, "ts", "user_id", "0 seconds", "event_type")
    closed = views.materialize(days, "daily")
    return closed.select(F.col("day").cast("timestamp_ntz").alias("day"), "event_type", "n")


@query(
    "stream_index_load",
    """SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS created_at_dt, event_type FROM events
WHERE contains(lower(event_type), 'click') OR event_type IN ('purchase', 'signup')""",
)
def stream_index_load(spark: SparkSession, sf: str) -> DataFrame:
    """Incremental index build: the checkpoint replaces the high-water mark."""
    wanted = F.lower("event_type").contains("click") | F.col("event_type").isin(
        "purchase", "signup"
    )
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    rows = _stream(spark, sf, "events").filter(wanted)
    return views.materialize(
        rows.select("event_id", day.alias("created_at_dt"), "event_type"), "index-load"
    )


def _arrive(rows: DataFrame, folder: str, *parts: int) -> None:
    """New files of a folder: one per part, in their order."""
    for part in parts:
        rows.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(folder)


_ARRIVALS = f"""WITH {b.DOCS}, arrivals AS (
  SELECT id, created_at, created_at_dt, n_chars AS data_size, retrieved_at,
    CASE WHEN app = 'lens' THEN CASE WHEN id % 2 = 0 THEN 'lenster' ELSE 'hey.xyz' END ELSE app END AS app
  FROM docs)"""


@query(
    "stream_tracker_late",
    f"""{_ARRIVALS} SELECT p.id, i.created_at_dt, i.created_at, i.app, p.retrieved_at, i.data_size
FROM arrivals p LEFT JOIN (SELECT * FROM arrivals WHERE id % 11 <> 4) i USING (id)""",
)
def stream_tracker_late(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads and index rows as streams. Of three, one index row comes five minutes before
    its payload, one after it, one with it; every eleventh never comes. Two starts on one
    checkpoint, with new files in between; two last files on each side close the time."""
    idx = b.index(spark, sf)
    retrieved = b.documents(spark, sf).select("id", "retrieved_at")
    start, last = retrieved.agg(F.min("retrieved_at"), F.max("retrieved_at")).first()
    quarter = (last - start) / 4

    def part(ts: str) -> F.Column:
        bounds = [F.col(ts) >= F.lit(start + i * quarter) for i in (1, 2, 3)]
        return sum((x.cast("int") for x in bounds), F.lit(0)).alias("part")

    def closing(rows: DataFrame, ts: str) -> DataFrame:
        end = F.lit(last + dt.timedelta(days=1))
        row = rows.limit(1).withColumns({"id": F.lit(-1).cast("bigint"), ts: end})
        row = row.withColumn("part", F.explode(F.array(F.lit(4), F.lit(5))))
        return row.select(*rows.columns)

    shift = F.expr("make_dt_interval(0, 0, 5 * (id % 3 - 1), 0)")
    indexed = idx.filter("id % 11 <> 4").join(retrieved, "id").withColumn("indexed_at", F.col("retrieved_at") + shift)
    base = scratch_path(spark, "late-index")
    sides = {}
    for name, rows, ts in (("payloads", retrieved, "retrieved_at"), ("index", indexed.drop("retrieved_at"), "indexed_at")):
        rows = rows.withColumn("part", part(ts))
        sides[name] = cut_lineage(rows.unionByName(closing(rows, ts)))
    for parts in ((0, 1), (2, 3, 4, 5)):
        streams = []
        for name, rows in sides.items():
            _arrive(rows, f"{base}/{name}", *parts)
            streams.append(views.file_stream(spark, f"{base}/{name}", rows.drop("part").schema, files_per_batch=1))
        joined = views.tracker_with_late_index(*streams, "10 minutes")
        views.run_to_table(joined, f"{base}/tracker", f"{base}/checkpoint")
    found = spark.read.parquet(f"{base}/tracker").filter("id >= 0")  # not in the stream: below its watermark
    return found.withColumn("retrieved_at", F.col("retrieved_at").cast("timestamp_ntz"))


@query(
    "stream_newest_changes",
    """WITH parts AS (SELECT user_id, event_id, event_type, ts,
    event_id * 3 // (SELECT max(event_id) + 1 FROM events) AS part FROM events),
newest AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY part, user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_id, event_type, ts FROM newest
QUALIFY (ts, event_id) > coalesce(max((ts, event_id)) OVER (PARTITION BY user_id ORDER BY part
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), (TIMESTAMP '1900-01-01', 0::BIGINT))""",
)
def stream_newest_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The newest row per user as keyed state: each batch passes on what it changes. The
    second start goes on from the state of the first, with two more files."""
    events = tb.read(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    n = events.agg(F.max("event_id")).first()[0] or 0
    dealt = events.withColumn("part", F.floor(F.col("event_id") * 3 / (n + 1)).cast("int"))
    base = scratch_path(spark, "newest")
    with views.keyed_state(spark):
        for parts in ((0,), (1, 2)):
            _arrive(dealt, f"{base}/events", *parts)
            stream = views.file_stream(spark, f"{base}/events", events.schema, files_per_batch=1)
            changes = views.newest_changes(stream, ["user_id"], ["ts", "event_id"], dt.timedelta(days=90))
            views.run_updates_to_table(changes, f"{base}/changes", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/changes").select(*events.columns)
