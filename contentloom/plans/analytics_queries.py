"""Filters, projections, usage analytics and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contentloom.functions import fingerprint as fp, text as text_fn
from contentloom.functions.core import (
    contains_any_ignore_case,
    json_value,
    matching_patterns,
    readable_bytes,
    tag_value,
    tag_value_from_pairs,
)
from contentloom.operators import analytics, sketches
from contentloom.plans import bindings as b
from contentloom.plans.registry import Family
from contentloom.session import written
from contentloom.sources.tables import read

FAMILY = Family()
query = FAMILY.query


# ---- scans and projections -----------------------------------------------------------


@query("scan_projection", "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders")
def scan_projection(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")
    )


@query(
    "point_lookup",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey = 777 AND CAST(o_orderdate AS DATE) = (
  SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey = 777)""",
)
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders")
    one = F.col("o_orderkey") == 777
    day = orders.filter(one).select(F.to_date("o_orderdate")).scalar()
    return orders.filter(one & (F.to_date("o_orderdate") == day)).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    "star_limit",
    f"""WITH {b.DOCS}, {b.stats_cte('docs')} SELECT id, lang, source, app, cycle,
  alpha_token_count, non_alpha_char_count FROM stats ORDER BY id LIMIT 100""",
)
def star_limit(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows are cut before the statistics are computed."""
    first = b.documents(spark, sf).orderBy("id").limit(100)
    return text_fn.with_char_stats(first).select(
        "id", "lang", "source", "app", "cycle", "alpha_token_count", "non_alpha_char_count"
    )


@query(
    "app_latest",
    f"WITH {b.DOCS} SELECT id, app, retrieved_at FROM docs WHERE app = 'mirrorxyz' ORDER BY retrieved_at DESC LIMIT 100",
)
def app_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.documents(spark, sf).filter(F.col("app") == "mirrorxyz")
    return rows.orderBy(F.desc("retrieved_at")).select("id", "app", "retrieved_at").limit(100)


@query(
    "cast_and_collections",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CAST(2 AS INTEGER) AS n_items, event_type AS first_item, CAST(0 AS INTEGER) AS n_empty,
  value AS map_value, CAST(NULL AS DOUBLE) AS map_missing
FROM events""",
)
def cast_and_collections(spark: SparkSession, sf: str) -> DataFrame:
    items = F.array("event_type", F.col("user_id").cast("string"))
    by_type = F.create_map(F.col("event_type"), F.col("value"))
    pair = F.struct(F.col("event_type").alias("h1"), F.col("value").alias("h2"))
    rows = read(spark, sf, "events").withColumn("pair", pair)
    return rows.select(
        "event_id", json_value("props", "$.k").try_cast("int").alias("k"),
        F.size(items).alias("n_items"), F.col("pair.h1").alias("first_item"),
        F.size(F.array()).alias("n_empty"),
        F.try_element_at(by_type, F.col("event_type")).alias("map_value"),
        F.try_element_at(by_type, F.lit("absent")).alias("map_missing"),
    )


# ---- predicates --------------------------------------------------------------------------


@query(
    "multi_substring_filter",
    "SELECT event_id, event_type FROM events WHERE event_type ILIKE '%ERR%' OR event_type ILIKE '%Chase%'",
)
def multi_substring_filter(spark: SparkSession, sf: str) -> DataFrame:
    wanted = contains_any_ignore_case("event_type", ["ERR", "Chase"])
    return read(spark, sf, "events").filter(wanted).select("event_id", "event_type")


@query("ilike_filter", "SELECT doc_id AS id, lang FROM documents WHERE text NOT ILIKE '%THE %'")
def ilike_filter(spark: SparkSession, sf: str) -> DataFrame:
    return b.documents(spark, sf).filter(~F.col("body").ilike("%THE %")).select("id", "lang")


@query("like_prefix", "SELECT doc_id AS id, source FROM documents WHERE source LIKE 'src1%'")
def like_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return b.documents(spark, sf).filter(F.col("source").like("src1%")).select("id", "source")


@query(
    "case_label",
    """SELECT event_id, event_type,
  CASE WHEN event_type IN ('click', 'view') THEN 'video' ELSE 'text' END AS content_type
FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup')""",
)
def case_label(spark: SparkSession, sf: str) -> DataFrame:
    """The kept labels and the video labels are two lists, so both branches occur."""
    kept, video = ("click", "view", "purchase", "signup"), ("click", "view")
    label = F.when(F.col("event_type").isin(*video), "video").otherwise("text")
    return (
        read(spark, sf, "events").filter(F.col("event_type").isin(*kept))
        .select("event_id", "event_type", label.alias("content_type"))
    )


@query(
    "range_filter",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-05-01' AND o_totalprice >= 1000""",
)
def range_filter(spark: SparkSession, sf: str) -> DataFrame:
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in ("1996-03-01", "1996-05-01"))
    return (
        read(spark, sf, "orders")
        .filter(F.col("o_orderdate").between(lo, hi) & (F.col("o_totalprice") >= 1000))
        .select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    )


@query(
    "tag_filter",
    """SELECT event_id, 'v' || CAST(json_extract_string(props, '$.k') AS VARCHAR) AS version FROM events
WHERE event_type = 'click'""",
)
def tag_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Tags once as a map and once as an array of pairs."""
    rows = read(spark, sf, "events").withColumn("_k", json_value("props", "$.k"))
    rows = rows.select(
        "event_id",
        F.create_map(F.lit("User-Agent"), F.col("event_type")).alias("tags"),
        F.array(
            F.struct(
                F.lit("Version").alias("name"), F.concat(F.lit("v"), "_k").alias("value")
            )
        ).alias("pairs"),
    )
    return rows.filter(tag_value("tags", "User-Agent") == "click").select(
        "event_id", tag_value_from_pairs("pairs", "Version").alias("version")
    )


@query(
    "boolean_filter",
    "SELECT count(DISTINCT user_id) AS distinct_owners FROM events WHERE value > 50",
)
def boolean_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "events").select("user_id", (F.col("value") > 50).alias("is_bundle"))
    return rows.filter("is_bundle").agg(F.countDistinct("user_id").alias("distinct_owners"))


# ---- usage analytics -----------------------------------------------------------------------


@query(
    "monthly_activity",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS transactions,
  count(DISTINCT o_custkey) AS monthly_active_users FROM orders GROUP BY 1""",
)
def monthly_activity(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.monthly_activity(read(spark, sf, "orders"), "o_orderdate", "o_custkey")


_EXACT = """count(*) AS n, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS total, TRUE AS actors_close,
  TRUE AS median_close, TRUE AS quartile_close"""


@query(
    "activity_from_sketches",
    f"""SELECT 'month' AS unit, CAST(date_trunc('month', o_orderdate) AS DATE) AS start, {_EXACT} FROM orders GROUP BY 2
UNION ALL SELECT 'quarter', CAST(date_trunc('quarter', o_orderdate) AS DATE), {_EXACT} FROM orders GROUP BY 2""",
)
def activity_from_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Months and quarters from a stored daily table, against the exact figures: distinct
    actors within five standard errors, ranks of the quantiles within two hundredths."""
    orders = read(spark, sf, "orders")
    daily = written(sketches.daily_sketches(orders, "o_orderdate", "o_custkey", "o_totalprice"), "daily")
    wanted = {"median": 0.5, "quartile": 0.25}
    out = []
    for unit in ("month", "quarter"):
        start = lambda c: F.date_trunc(unit, c).cast("date").alias("start")  # noqa: B023, E731
        found = sketches.figures(sketches.merged(daily, start("day")), **wanted)
        rows = orders.select(start("o_orderdate"), "o_custkey", F.col("o_totalprice").cast("bigint").alias("price"))
        below = [F.sum((F.col("price") < F.col(q)).cast("double")).alias(f"below_{q}") for q in wanted]
        upto = [F.sum((F.col("price") <= F.col(q)).cast("double")).alias(f"upto_{q}") for q in wanted]
        exact = rows.join(F.broadcast(found), "start").groupBy("start").agg(
            F.count_distinct("o_custkey").alias("exact"), *below, *upto
        )
        error = 5 * 1.04 / 2 ** (sketches.LG_REGISTERS / 2)
        close = {
            f"{q}_close": (F.col(f"below_{q}") <= (at + 0.02) * F.col("n")) & (F.col(f"upto_{q}") >= (at - 0.02) * F.col("n"))
            for q, at in wanted.items()
        }
        out.append(
            found.join(exact, "start").select(
                F.lit(unit).alias("unit"), "start", "n", "total",
                (F.abs(F.col("n_actors") - F.col("exact")) <= F.greatest(F.lit(1.0), error * F.col("exact"))).alias("actors_close"),
                *[c.alias(name) for name, c in close.items()],
            )
        )
    return out[0].union(out[1])


@query(
    "daily_events",
    """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""",
)
def daily_events(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count("*").alias("n")
    )


_QUANTILES = {
    "median_cnt": 0.5,
    "bottom_5_percentile": 0.05,
    "bottom_10_percentile": 0.10,
    "top_10_percentile": 0.90,
    "top_5_percentile": 0.95,
}


@query(
    "actor_quantiles",
    "WITH q AS (SELECT o_custkey, count(*) AS cnt FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY 1) SELECT "
    + ", ".join(f"round(quantile_cont(cnt, {v}), 6) AS {k}" for k, v in _QUANTILES.items())
    + " FROM q",
)
def actor_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    since = F.lit("1995-01-01").cast("timestamp_ntz")
    rows = read(spark, sf, "orders").filter(F.col("o_orderdate") >= since)
    out = analytics.actor_quantiles(rows, "o_custkey", _QUANTILES)
    return out.select(*[F.round(c, 6).alias(c) for c in _QUANTILES])


@query(
    "count_histogram",
    """WITH agg AS (SELECT user_id, count(*) AS cnt FROM events GROUP BY 1)
SELECT cnt, count(*) AS n_actors FROM agg GROUP BY cnt""",
)
def count_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.count_histogram(read(spark, sf, "events"), "user_id")


@query(
    "distinct_actors",
    """SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS distinct_owner,
  count(DISTINCT o_orderpriority) AS distinct_priority, count(DISTINCT o_orderdate) AS distinct_day
FROM orders""",
)
def distinct_actors(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.distinct_counts(
        read(spark, sf, "orders"),
        {"owner": "o_custkey", "priority": "o_orderpriority", "day": "o_orderdate"},
    )


@query(
    "approx_distinct",
    "SELECT count(*) AS n_rows, count(DISTINCT l_partkey) AS n_parts, TRUE AS close FROM lineitem",
)
def approx_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """The sketch differs from engine to engine, so it is held against the exact number. Each has
    its own aggregate: beside a distinct count there would be a sketch for every part."""
    lines = read(spark, sf, "lineitem").select("l_partkey")
    exact = lines.groupBy("l_partkey").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("l_partkey").alias("n_parts")
    )
    counts = exact.crossJoin(lines.agg(F.approx_count_distinct("l_partkey", 0.01).alias("about")))
    close = F.abs(F.col("about") - F.col("n_parts")) <= 0.05 * F.col("n_parts")
    return counts.select("n_rows", "n_parts", close.alias("close"))


@query(
    "semi_join_exact_count",
    """WITH agg AS (SELECT user_id, count(*) AS cnt FROM events GROUP BY 1),
pick AS (SELECT cnt FROM agg GROUP BY cnt ORDER BY count(*) DESC, cnt LIMIT 1)
SELECT event_id, user_id, event_type FROM events
WHERE user_id IN (SELECT user_id FROM agg WHERE cnt = (SELECT cnt FROM pick)) AND event_type = 'view'""",
)
def semi_join_exact_count(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the actors that have the most common number of rows."""
    events = read(spark, sf, "events").select("event_id", "user_id", "event_type")
    mode = (
        analytics.count_histogram(events, "user_id")
        .orderBy(F.desc("n_actors"), "cnt").first()["cnt"]
    )
    found = analytics.rows_of_actors_with_count(events, "user_id", mode)
    return found.filter(F.col("event_type") == "view").select("event_id", "user_id", "event_type")


@query(
    "cte_grouped_order",
    """SELECT o_custkey, count(*) AS cnt FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200""",
)
def cte_grouped_order(spark: SparkSession, sf: str) -> DataFrame:
    since = F.lit("1995-01-01").cast("timestamp_ntz")
    recent = read(spark, sf, "orders").filter(F.col("o_orderdate") >= since)
    return analytics.actor_counts(recent, "o_custkey").orderBy(F.desc("cnt"), "o_custkey").limit(200)


@query("distinct_ids", "SELECT DISTINCT l_orderkey, l_shipdate FROM lineitem")
def distinct_ids(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select("l_orderkey", "l_shipdate").distinct()


@query(
    "tag_count_ilike",
    "SELECT event_type, count(*) AS n FROM events WHERE event_type ILIKE 'C%' OR event_type ILIKE 'VIEW' GROUP BY 1",
)
def tag_count_ilike(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("event_type")
    return (
        read(spark, sf, "events").filter(t.ilike("C%") | t.ilike("VIEW"))
        .groupBy("event_type").agg(F.count("*").alias("n"))
    )


# ---- reports ---------------------------------------------------------------------------------

_COVERAGE = {
    "keybert_keywords": ("embeddings", "vec_id"),
    "meta_bart_categories": ("conversations", "conv_id"),
    "meta_text_embeddings": ("embeddings", "label"),
    "meta_text_style": ("labels", "doc_id"),
    "meta_text_summary": ("benchmark", "item_id"),
    "meta_text_title": ("pages", "page_id"),
    "spacy_entities": ("events", "user_id"),
    "flair_entities": ("lineitem", "l_orderkey"),
    "entities_metadata": ("orders", "o_custkey"),
}


@query(
    "coverage_report",
    " UNION ALL ".join(
        f"SELECT count(DISTINCT {key}) AS n_ids, '{label}' AS label FROM {table}"
        for label, (table, key) in _COVERAGE.items()
    ),
)
def coverage_report(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.coverage(
        {label: (read(spark, sf, t), key) for label, (t, key) in _COVERAGE.items()}
    )


_DATED = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts", "documents": None}


@query(
    "storage_report",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", {f'CAST(min({c}) AS DATE)' if c else 'CAST(NULL AS DATE)'} AS min_date,
  {f'CAST(max({c}) AS DATE)' if c else 'CAST(NULL AS DATE)'} AS max_date, count(*) > 0 AS sized FROM {t}"""
        for t, c in _DATED.items()
    ),
)
def storage_report(spark: SparkSession, sf: str) -> DataFrame:
    """File sizes are facts of the storage, which SQL over the views does not see: that
    there are some, in a readable form, is compared."""
    report = analytics.storage_report({t: (read(spark, sf, t), c) for t, c in _DATED.items()})
    sized = (F.col("size") > 0) & F.col("size_readable").rlike("^[0-9.]+ ?[A-Za-z]+$")
    return report.select("table", "min_date", "max_date", sized.alias("sized"))


@query(
    "readable_sizes",
    """SELECT doc_id AS id, CASE WHEN n >= 1048576 THEN printf('%.2f MiB', n / 1048576 + 1e-9)
  WHEN n >= 1024 THEN printf('%.2f KiB', n / 1024 + 1e-9) ELSE printf('%.2f B', n) END AS size
FROM (SELECT doc_id, CAST(n_chars * 64 AS DOUBLE) AS n FROM documents)""",
)
def readable_sizes(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return docs.select(F.col("doc_id").alias("id"), readable_bytes(F.col("n_chars") * 64).alias("size"))


@query(
    "pattern_indices",
    """SELECT doc_id AS id, CASE WHEN contains(text, 'tion') THEN '1' ELSE '' END
  || CASE WHEN contains(text, 'zzz') THEN '2' ELSE '' END
  || CASE WHEN regexp_matches(text, '[0-9]+') THEN '3' ELSE '' END AS indices,
  upper(sha1(text)) AS sha1 FROM documents""",
)
def pattern_indices(spark: SparkSession, sf: str) -> DataFrame:
    found = matching_patterns("body", ["tion", "zzz", "[0-9]+"])
    return b.documents(spark, sf).select(
        "id", F.array_join(found.cast("array<string>"), "").alias("indices"),
        fp.sha1_hex("body").alias("sha1"),
    )
