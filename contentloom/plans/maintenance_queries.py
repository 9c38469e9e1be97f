"""Sinks and table maintenance: every query writes a table and returns what it then holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contentloom.enrich import postings
from contentloom.operators.keyed import latest_per_key
from contentloom.plans import bindings as b
from contentloom.plans.registry import Family
from contentloom.session import scratch_path, scratch_table
from contentloom.sources import tables as tb

FAMILY = Family()
query = FAMILY.query


@query(
    "app_subset_table",
    f"""WITH {b.DOCS} SELECT id, app, created_at_dt, n_chars AS data_size,
  CASE WHEN app = 'lens' THEN 'video' ELSE 'text' END AS content_type
FROM docs WHERE app IN ('mirrorxyz', 'paragraph', 'lens')""",
)
def app_subset_table(spark: SparkSession, sf: str) -> DataFrame:
    """One table partitioned by application: each subset reads its own folders only."""
    label = F.when(F.col("app") == "lens", "video").otherwise("text")
    rows = b.documents(spark, sf).select(
        "id", "app", "created_at_dt", F.col("n_chars").alias("data_size"),
        label.alias("content_type"),
    )
    table = scratch_table(spark, "relevant")
    tb.write_clustered(rows, table, ["created_at_dt", "id"], partition_by=["app"])
    return spark.table(table).filter(F.col("app").isin("mirrorxyz", "paragraph", "lens")).select(
        "id", "app", "created_at_dt", "data_size", "content_type"
    )


@query(
    "typed_append",
    """SELECT doc_id AS id, CAST(n_chars AS INTEGER) AS n_chars, lang, TRUE AS stamped FROM documents""",
)
def typed_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends of a frame with more columns than the table, the text among them."""
    docs = b.documents(spark, sf).withColumn("processed_at", F.current_timestamp())
    table = scratch_table(spark, "appended")
    spark.sql(
        f"CREATE TABLE {table} (id bigint, n_chars int, lang string, processed_at timestamp) USING parquet"
    )
    tb.append(docs.filter(F.col("lang") == "en"), table)
    tb.append(docs.filter(F.col("lang") != "en"), table)
    stored = spark.table(table)
    return stored.select(
        "id", "n_chars", "lang", F.col("processed_at").isNotNull().alias("stamped")
    )


def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders as first loaded, and a later load that repeats some with a new status."""
    orders = tb.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    first = orders.withColumn("version", F.lit(1))
    later = orders.filter(F.col("o_custkey") % 3 == 0).withColumns(
        {"o_orderstatus": F.lit("X"), "version": F.lit(2)}
    )
    return first, later


_LATEST = """SELECT o_orderkey, o_custkey,
  CASE WHEN o_custkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CAST(CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS version FROM orders"""


@query("latest_per_key", _LATEST)
def latest_rows(spark: SparkSession, sf: str) -> DataFrame:
    first, later = _versions(spark, sf)
    return latest_per_key(first.unionByName(later), ["o_orderkey"], ["version"])


@query("keyed_replace", _LATEST)
def keyed_replace(spark: SparkSession, sf: str) -> DataFrame:
    """The later load is inserted twice, as after a retry."""
    first, later = _versions(spark, sf)
    table = scratch_table(spark, "replaced")
    first.write.format("parquet").saveAsTable(table)
    for _ in range(2):
        tb.keyed_replace(later, table, ["o_orderkey"], ["version"])
    return spark.table(table)


@query(
    "keyed_replace_partitions",
    """SELECT event_id, event_type, CAST(CASE WHEN day = DATE '2024-01-05' THEN 2 ELSE 1 END AS INTEGER) AS version, day
FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)""",
)
def keyed_replace_partitions(spark: SparkSession, sf: str) -> DataFrame:
    events = tb.read(spark, sf, "events").select(
        "event_id", "event_type", F.lit(1).alias("version"), F.to_date("ts").alias("day")
    )
    table = scratch_table(spark, "daily")
    events.write.format("parquet").partitionBy("day").saveAsTable(table)
    later = events.filter(F.col("day") == F.lit("2024-01-05").cast("date")).withColumn(
        "version", F.lit(2)
    )
    tb.keyed_replace_partitions(later, table, ["day", "event_id"], ["version"], "day")
    return spark.table(table)


@query("keyed_replace_bucketed", _LATEST)
def keyed_replace_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """A bucketed table keeps its buckets, so that its joins still shuffle nothing."""
    first, later = _versions(spark, sf)
    table = scratch_table(spark, "bucketed")
    tb.write_bucketed(first, table, ["o_orderkey"], 8)
    tb.keyed_replace(later, table, ["o_orderkey"], ["version"])
    return spark.table(table)


@query(
    "dedupe_by_columns",
    "SELECT DISTINCT o_custkey, o_orderdate, o_orderpriority FROM orders",
)
def dedupe_by_columns(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["o_custkey", "o_orderdate", "o_orderpriority"]
    orders = tb.read(spark, sf, "orders").select(*keys, "o_totalprice")
    table = scratch_table(spark, "deduplicated")
    orders.unionByName(orders).write.format("parquet").saveAsTable(table)
    tb.deduplicate(table, spark, keys)
    return spark.table(table).select(*keys)


@query(
    "delete_where",
    "SELECT event_id, ts, value FROM events WHERE NOT coalesce(ts > TIMESTAMP '2024-01-15', FALSE)",
)
def delete_where(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_table(spark, "deleted")
    tb.read(spark, sf, "events").select("event_id", "ts", "value").write.format(
        "parquet"
    ).saveAsTable(table)
    tb.delete_where(table, spark, F.col("ts") > F.lit("2024-01-15").cast("timestamp_ntz"))
    return spark.table(table)


@query(
    "delete_where_partitioned",
    "SELECT event_id, value, CAST(ts AS DATE) AS day FROM events WHERE event_id % 4 <> 1",
)
def delete_where_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_table(spark, "deleted_daily")
    events = tb.read(spark, sf, "events").select("event_id", "value", F.to_date("ts").alias("day"))
    tb.write_clustered(events, table, ["event_id"], partition_by=["day"])
    tb.delete_where(table, spark, F.col("event_id") % 4 == 1)
    return spark.table(table)


@query(
    "rebuild_swap",
    "SELECT event_id, ts, CAST(date_trunc('day', ts) AS TIMESTAMP) AS created_at_dt FROM events",
)
def rebuild_swap(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_table(spark, "rebuilt")
    tb.read(spark, sf, "events").select("event_id", "ts").write.format("parquet").saveAsTable(table)
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    tb.rebuild_and_swap(spark.table(table).withColumn("created_at_dt", day), table)
    return spark.table(table)


@query("json_lines_export", "SELECT event_id, user_id, event_type, value FROM events")
def json_lines_export(spark: SparkSession, sf: str) -> DataFrame:
    """Exported as JSON lines and read back."""
    columns = ["event_id", "user_id", "event_type", "value"]
    rows = tb.read(spark, sf, "events").select(*columns)
    path = scratch_path(spark, "json-lines")
    tb.export_json_lines(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query(
    "postings_table",
    """SELECT DISTINCT doc_id AS id FROM (SELECT doc_id, unnest(
  regexp_extract_all(lower(text), '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) AS term FROM documents) WHERE term = 'that'""",
)
def postings_table(spark: SparkSession, sf: str) -> DataFrame:
    """Postings stored by term bucket; the look-up reads the bucket of its term."""
    path = scratch_path(spark, "postings")
    postings.write_postings(postings.postings(b.documents(spark, sf)), path, buckets=16)
    return postings.stored_ids(spark.read.parquet(path), "that", buckets=16)
