"""Typed content rows from raw payloads of several applications."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from contentloom.functions.core import computed_once, let
from contentloom.functions.variants import parsed, text_at, texts_at


@dataclass(frozen=True)
class PayloadFormat:
    """Where an application keeps its fields. ``envelope`` is the path of a JSON document
    held as a string; ``required`` a (path, value) the payload must have."""

    labels: tuple[str, ...]
    body: str
    content_timestamp: str
    title: str
    contributor: str
    tags: str | None = None
    address: str | None = None
    envelope: str | None = None
    required: tuple[str, str] | None = field(default=None)


# Source labels and JSON paths of the four JSON applications.
FORMATS = {
    "paragraph": PayloadFormat(
        labels=("paragraph",),
        body="$.markdown",
        content_timestamp="$.publishedAt",
        title="$.title",
        contributor="$.authors[0]",
        tags="$.categories",
    ),
    "lens": PayloadFormat(
        labels=("lenster", "hey.xyz"),
        body="$.content",
        content_timestamp="$.createdOn",
        title="$.name",
        contributor="$.external_url",
        tags="$.tags",
        required=("$.mainContentFocus", "TEXT_ONLY"),
    ),
    "mirrorxyz": PayloadFormat(
        labels=("mirrorxyz",),
        body="$.content.body",
        content_timestamp="$.content.timestamp",
        title="$.content.title",
        contributor="$.authorship.contributor",
    ),
    "cyberconnect": PayloadFormat(
        labels=("cyberconnect",),
        body="$.body",
        content_timestamp="$.ts",
        title="$.title",
        contributor="$.handle",
        address="$.author",
        envelope="$.content",
        required=("$.op", "post"),
    ),
}
TRANSCRIPT_APP = "odysee"

# Column name -> path below the payload root of the deep projection.
DEEP_FIELDS = {
    "content": "content.body",
    "content_timestamp": "content.timestamp",
    "title": "content.title",
    "digest": "digest",
    "contributor": "authorship.contributor",
    "signing_key": "authorship.signingKey",
    "signature": "authorship.signature",
    "signing_key_signature": "authorship.signingKeySignature",
    "signing_key_message": "authorship.signingKeyMessage",
    "algorithm_name": "authorship.algorithm.name",
    "algorithm_hash": "authorship.algorithm.hash",
    "version_date": "version",
    "wnft_chain_id": "wnft.chainId",
    "wnft_description": "wnft.description",
    "wnft_funding_recipient": "wnft.fundingRecipient",
    "wnft_image_uri": "wnft.imageURI",
    "wnft_media_asset_id": "wnft.mediaAssetId",
    "wnft_name": "wnft.name",
    "wnft_nonce": "wnft.nonce",
    "wnft_owner": "wnft.owner",
    "wnft_price": "wnft.price",
    "wnft_proxy_address": "wnft.proxyAddress",
    "wnft_renderer": "wnft.renderer",
    "wnft_supply": "wnft.supply",
    "wnft_symbol": "wnft.symbol",
    "wnft_has_custom_media": "wnft.hasCustomWnftMedia",
}

SCALAR_FIELDS = ("body", "content_timestamp", "title", "contributor")
CONTENT_FIELDS = (*SCALAR_FIELDS, "tags")
NO_TAGS = "array<string>"


def _payload(fmt: PayloadFormat, raw: Column) -> Column:
    """struct of the fields of one format, NULL for payloads that it does not accept.

    A payload is parsed once, a document inside it that is held as a string once more.
    """

    def fields(document: Column, text: Column) -> Column:
        tags = texts_at(document, fmt.tags, text) if fmt.tags else F.array().cast(NO_TAGS)
        address = text_at(document, fmt.address, text) if fmt.address else F.lit(None).cast("string")
        found = F.struct(
            *[text_at(document, getattr(fmt, n), text).alias(n) for n in SCALAR_FIELDS],
            tags.alias("tags"),
            address.alias("address"),
        )
        if not fmt.required:
            return found
        path, value = fmt.required
        return F.when(text_at(document, path, text) == value, found)

    def inner(outer: Column) -> Column:
        return let(
            text_at(outer, fmt.envelope, raw), lambda text: let(parsed(text), lambda doc: fields(doc, text))
        )

    return let(parsed(raw), inner if fmt.envelope else lambda doc: fields(doc, raw))


def extract_app(payloads: DataFrame, app: str, raw: str = "content", label: str = "app") -> DataFrame:
    """Content rows of one application. ``payloads`` carries the index label."""
    fmt = FORMATS[app]
    rows = payloads.filter(F.col(label).isin(*fmt.labels)).select("id", "created_at", "retrieved_at", F.col(raw))
    rows = computed_once(rows, {"_f": _payload(fmt, F.col(raw))}).filter("_f IS NOT NULL")
    names = [*CONTENT_FIELDS, *(["address"] if fmt.address else [])]
    return rows.select("id", "created_at", "retrieved_at", *[f"_f.{n}" for n in names], F.lit(app).alias("app"))


def extract_all(payloads: DataFrame, raw: str = "content", label: str = "app") -> DataFrame:
    """Content rows of every JSON application in one pass over the payloads.

    Same rows as the union of ``extract_app``, but the payload table, by far the largest
    input, is scanned once instead of once per application.
    """
    app, found = F.lit(None), None
    for name, fmt in FORMATS.items():
        test = F.col(label).isin(*fmt.labels)
        app = F.when(test, F.lit(name)).otherwise(app)
        payload = _payload(fmt, F.col(raw))
        found = F.when(test, payload) if found is None else found.when(test, payload)
    known = [x for fmt in FORMATS.values() for x in fmt.labels]
    # The application is a plain column below the parsing, so a filter on it goes there too.
    rows = payloads.filter(F.col(label).isin(*known)).select(
        "id", "created_at", "retrieved_at", F.col(raw), F.col(label), app.alias("_app")
    )
    rows = computed_once(rows, {"_f": found}).filter("_f IS NOT NULL")
    return rows.select(
        "id", "created_at", *[f"_f.{n}" for n in CONTENT_FIELDS], "retrieved_at", F.col("_app").alias("app")
    )


def transcript_content(transcripts: DataFrame) -> DataFrame:
    """Transcripts in the shape of content rows: constants where they have no field."""
    return transcripts.select(
        F.col("source_url").alias("id"),
        "created_at",
        F.col("fulltext").alias("body"),
        *[F.lit("").alias(c) for c in ("content_timestamp", "title", "contributor")],
        F.array().cast(NO_TAGS).alias("tags"),
        F.col("created_at").alias("retrieved_at"),
        F.lit(TRANSCRIPT_APP).alias("app"),
    )


def _deep_schema() -> str:
    """DDL of the nested payload, built from the field paths."""
    tree: dict = {}
    for path in DEEP_FIELDS.values():
        node = tree
        *parents, leaf = path.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = None

    def ddl(node: dict) -> str:
        return ", ".join(
            f"{k}: string" if v is None else f"{k}: struct<{ddl(v)}>" for k, v in node.items()
        )

    return f"struct<{ddl(tree)}>"


def deep_projection(files: DataFrame, raw: str = "content", key: str = "id") -> DataFrame:
    """All nested fields as columns from one parse per document; '' where missing."""
    parsed = files.select(
        F.col(key).alias("content_id"), F.from_json(F.col(raw), _deep_schema()).alias("_j")
    )
    return parsed.select(
        "content_id",
        *[
            F.coalesce(F.col(f"_j.{path}"), F.lit("")).alias(name)
            for name, path in DEEP_FIELDS.items()
        ],
    )
