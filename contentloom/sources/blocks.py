"""Block records and endpoint registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contentloom import schemas
from contentloom.functions.core import computed_once
from contentloom.functions.fingerprint import hash64
from contentloom.functions.variants import number_at, parsed
from contentloom.operators.keyed import with_ordinal

# Endpoints that are always part of the list.
BASE_ENDPOINTS = (
    "https://arweave.net/",
    "https://g8way.io/",
    "https://arweave.dev/",
    "https://ar-io.dev/",
)


def parse_blocks(raw: DataFrame, text: str = "response_str") -> DataFrame:
    """Typed block rows, the record as a variant and as it came; malformed records and
    records without height or time are dropped. A record is parsed once."""
    rows = computed_once(raw.select(F.col(text).alias("_raw")), {"_doc": parsed("_raw")})
    return rows.select(
        number_at(F.col("_doc"), "$.height", "int").alias("height"),
        F.timestamp_seconds(number_at(F.col("_doc"), "$.timestamp", "bigint")).alias("block_timestamp"),
        F.current_timestamp().alias("inserted_at"),
        F.col("_doc").alias("data_raw"),
        F.col("_raw").alias("data_raw_str"),
    ).filter("height IS NOT NULL AND block_timestamp IS NOT NULL")


def registry_endpoints(registry: DataFrame, text: str) -> DataFrame:
    """One URL per entry of a JSON registry."""
    entries = registry.select(
        F.explode(F.from_json(text, schemas.ENDPOINT_REGISTRY)["gateways"]).alias("_id", "_g")
    )
    url = F.concat(
        F.col("_g.settings.protocol"), F.lit("://"), F.col("_g.settings.fqdn"), F.lit("/")
    )
    return entries.select(url.alias("endpoint")).filter(F.col("endpoint").isNotNull())


def endpoint_list(registry_urls: DataFrame, base: Sequence[str] = BASE_ENDPOINTS) -> DataFrame:
    """Registry and base endpoints without repeats."""
    fixed = registry_urls.sparkSession.createDataFrame([(u,) for u in base], "endpoint string")
    return registry_urls.select("endpoint").union(fixed).distinct()


def assign_round_robin(work: DataFrame, key: str, endpoints: DataFrame) -> DataFrame:
    """Give work item i the endpoint i mod n. Both sides are numbered without a global
    window; the endpoint list joins by its number and stays a shuffle join if it is long."""
    numbered = endpoints.withColumn("_h", hash64(F.col("endpoint")))
    slots = with_ordinal(numbered, "_h", "_slot").drop("_h")
    return _deal(with_ordinal(work, key, "_i"), slots)


def _deal(work: DataFrame, slots: DataFrame) -> DataFrame:
    n = slots.agg(F.count("*")).scalar()
    return (
        work.withColumn("_slot", F.pmod(F.col("_i"), n))
        .join(slots, "_slot")
        .drop("_slot", "_i")
    )


def is_downloaded(created_date: Column | str = "created_date") -> Column:
    """A download without a date is a failed one."""
    c = F.col(created_date) if isinstance(created_date, str) else created_date
    return c.isNotNull()
