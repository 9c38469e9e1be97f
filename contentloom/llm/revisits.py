"""WARC revisits of unmodified pages, resolved by an as-of join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from contentloom.llm.common import ascii_lower, materialize

# The header fields that a not-modified answer may replace in a stored one.
PERMITTED = (
    "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary",
)
HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Without scheme, default port, ``www.``, fragment and tracking parameters; A-Z of the
    host in lower case, parameters in order, an empty path as ``/``. NULL without ``://``."""
    host = ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^www[.]", "")
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, "://[^?#]*[?]([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    query = F.array_join(F.array_sort(kept), "&")
    canonical = F.concat(
        host,
        F.when(path == "", "/").otherwise(path),
        F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)),
    )
    return F.when(url.contains("://"), canonical)


def latest_earlier(points: DataFrame, buckets: int) -> DataFrame:
    """``points`` (url, time, response or NULL; a row per url and time) with ``found``: the
    response of the latest earlier point that has one.

    Time is cut into equal stretches. Within a stretch a window looks back; what came before
    it is the last response of the earlier stretches, of which a URL has ``buckets`` at
    most. So the captures of a very hot URL are spread over as many tasks as it has stretches.
    """
    span = points.agg(F.min("time"), F.max("time")).first()
    low, width = span[0] or 0, max(1, -(-((span[1] or 0) - (span[0] or 0) + 1) // buckets))
    cut = points.withColumn("bucket", F.floor((F.col("time") - low) / width))
    last = cut.filter("response IS NOT NULL").groupBy("url", "bucket").agg(
        F.max_by("response", "time").alias("last")
    )
    filled = cut.select("url", "bucket").distinct().join(last, ["url", "bucket"], "left")
    before = Window.partitionBy("url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = filled.select("url", "bucket", F.last("last", ignorenulls=True).over(before).alias("carried"))
    within = Window.partitionBy("url", "bucket").orderBy("time").rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("near", F.last("response", ignorenulls=True).over(within))
        .join(carried, ["url", "bucket"])
        .select("url", "time", F.coalesce("near", "carried").alias("found"))
    )


def _agree(left: Column, right: Column) -> Column:
    return F.when(left.isNotNull() & right.isNotNull(), left == right)


def merge_headers(stored: Column, update: Column) -> Column:
    """The stored header fields, the permitted ones replaced by the update's."""
    lower = lambda h: ascii_lower(h["name"])
    empty = F.array().cast(HEADERS)
    stored, update = F.coalesce(stored, empty), F.coalesce(update, empty)
    fresh = F.filter(update, lambda h: F.coalesce(lower(h).isin(*PERMITTED), F.lit(False)))
    names = F.transform(fresh, lower)
    kept = F.filter(stored, lambda h: ~F.coalesce(F.array_contains(names, lower(h)), F.lit(False)))
    return F.concat(kept, fresh)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Resolve every not-modified revisit to the full response it stands for.

    ``records``: record_id, url, time (whole number), type (``response`` or ``revisit``; other
    types are left out), etag, last_modified, digest, headers (array of name, value). The
    response is the latest strictly earlier one of the same canonical URL, of equal times
    that of the largest record_id. The first validator that both have decides: entity tag
    (weak comparison), time of modification, payload digest.

    One row per revisit: record_id, canonical_url, response_id, status (``resolved``,
    ``mismatch``, ``unchecked`` without common validator, ``missing`` without response),
    headers (merged where resolved, else the revisit's own). Records without URL or time
    find nothing; repeated revisits are resolved each, repeated responses are one; an empty
    table gives no rows; other columns are ignored.
    """
    used = ["record_id", "url", "time", "type", "etag", "last_modified", "digest", "headers"]
    rows = materialize(
        records.filter("type IN ('response', 'revisit')")
        .select(*used)
        .withColumns({"url": canonical_url(F.col("url")), "_row": F.monotonically_increasing_id()}),
        "records",
    )
    full = F.col("type") == "response"
    points = rows.filter("url IS NOT NULL AND time IS NOT NULL").groupBy("url", "time").agg(
        F.max(F.when(full, F.struct("record_id", "_row"))).alias("response"),
        F.max(~full).alias("asked"),
    )
    total = rows.count()
    points = materialize(points, "points")
    found = latest_earlier(points, max(1, round(total**0.5))).filter("found IS NOT NULL")
    stored = rows.filter(full).select(
        F.col("_row").alias("_response"),
        F.col("record_id").alias("response_id"),
        *[F.col(c).alias(f"_{c}") for c in ("etag", "last_modified", "digest", "headers")],
    )
    tag = lambda c: F.regexp_replace(c, "^W/", "")
    agree = F.coalesce(
        _agree(tag("etag"), tag("_etag")),
        _agree(F.col("last_modified"), F.col("_last_modified")),
        _agree(F.col("digest"), F.col("_digest")),
    )
    status = (
        F.when(F.col("_response").isNull(), "missing")
        .when(agree.isNull(), "unchecked")
        .when(agree, "resolved")
        .otherwise("mismatch")
    )
    own = F.coalesce("headers", F.array().cast(HEADERS))
    return (
        rows.filter(~full)
        .join(found.select("url", "time", F.col("found._row").alias("_response")), ["url", "time"], "left")
        .join(stored, "_response", "left")
        .withColumn("status", status)
        .select(
            "record_id",
            F.col("url").alias("canonical_url"),
            "response_id",
            "status",
            F.when(F.col("status") == "resolved", merge_headers(F.col("_headers"), F.col("headers")))
            .otherwise(own)
            .alias("headers"),
        )
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl of the given pages, as records: every page is captured once in full, and asked
    for again under a variant of its URL. Some pages change in between, some give a time
    instead of a tag, some are asked for before they are captured."""
    page, html = F.col("page_id"), F.coalesce("html", F.lit(""))
    full = F.struct(
        (page * 2).alias("record_id"),
        F.col("url"),
        (page * 3600 % 1_000_003).alias("time"),
        F.lit("response").alias("type"),
        F.when(page % 3 != 1, F.concat(F.lit('"'), F.md5(html), F.lit('"'))).alias("etag"),
        F.when(page % 7 != 1, F.concat(F.lit("day "), page % 365)).alias("last_modified"),
        F.sha1(html).alias("digest"),
    )
    again = F.struct(
        (page * 2 + 1).alias("record_id"),
        F.when(page % 2 == 0, F.concat(F.col("url"), F.lit("#again"))).otherwise(F.col("url")).alias("url"),
        (page * 3600 % 1_000_003 + F.when(page % 11 == 0, -7).otherwise(86_400)).alias("time"),
        F.lit("revisit").alias("type"),
        F.when(
            page % 3 != 1,
            F.concat(F.lit('W/"'), F.md5(F.when(page % 5 == 0, F.concat(html, F.lit("!"))).otherwise(html)), F.lit('"')),
        ).alias("etag"),
        F.when(page % 7 != 1, F.concat(F.lit("day "), page % 365)).alias("last_modified"),
        F.lit(None).cast("string").alias("digest"),
    )
    header = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    headers = F.filter(
        F.array(
            header("Date", F.col("time")),
            header("ETag", F.col("etag")),
            header("Content-Type", F.when(F.col("type") == "response", "text/html").otherwise("none")),
        ),
        lambda h: h["value"].isNotNull(),
    )
    return pages.select(F.inline(F.array(full, again))).withColumn("headers", headers)
