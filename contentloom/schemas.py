"""Table schemas of the pipeline, as DDL text (usable before a session exists)."""

from __future__ import annotations

# Entity type names of the two extractors and of the merged table.
ENTITY_TYPES_11 = (
    "PERSON", "NORP", "FAC", "ORG", "GPE", "LOC",
    "PRODUCT", "EVENT", "WORK_OF_ART", "LAW", "LANGUAGE",
)
ENTITY_TYPES_18 = (
    "CARDINAL", "DATE", "EVENT", "FAC", "GPE", "LANGUAGE", "LAW", "LOC", "MONEY",
    "NORP", "ORDINAL", "ORG", "PERCENT", "PERSON", "PRODUCT", "QUANTITY", "TIME",
    "WORK_OF_ART",
)
ENTITY_TYPES_15 = (
    "PERSON", "NORP", "FAC", "ORG", "GPE", "LOC", "PRODUCT", "EVENT", "WORK_OF_ART",
    "LAW", "DATE", "LANGUAGE", "MONEY", "QUANTITY", "TIME",
)
# Topic labels, lower case.
TOPIC_LABELS = (
    "pop culture", "artists", "education", "comedy", "lifestyle", "music", "sports",
    "gaming", "tech", "finance", "spirituality", "news & politics", "universe",
    "rabbit hole",
)


def entity_columns(types) -> list[str]:
    return [f"{t.lower()}_entities" for t in types]


def _entities(types) -> str:
    cols = ", ".join(f"{c} string" for c in entity_columns(types))
    return f"id string, {cols}, created_at timestamp"


STATS = (
    "ngram_min_hash struct<h1: bigint, h2: bigint>, ngram_hash bigint, "
    "languages map<string, double>, alpha_token_count bigint, alpha_char_count bigint, "
    "total_char_count bigint, non_alpha_char_count bigint, non_alpha_ratio double, "
    "alpha_ratio double"
)

BLOCKS = (
    "height int, block_timestamp timestamp, inserted_at timestamp, "
    "data_raw variant, data_raw_str string"
)
INDEX = (
    "id string, created_at timestamp, created_at_dt timestamp, data_size bigint, app string"
)
PAYLOADS = (
    "id string, created_at timestamp, created_at_dt timestamp, "
    "retrieved_at timestamp, content string"
)
TRACKER = (
    "id string, created_at_dt timestamp, created_at timestamp, app string, "
    "retrieved_at timestamp, data_size bigint"
)
CONTENT = (
    "id string, created_at timestamp, body string, content_timestamp string, title string, "
    f"contributor string, tags array<string>, {STATS}, retrieved_at timestamp, app string"
)
QUALITY_SCORE = (
    "id string, retrieved_at timestamp, created_at timestamp, processed_at timestamp, "
    "eng_quality float, content_short string"
)
ENTITIES_11 = _entities(ENTITY_TYPES_11)
ENTITIES_18 = _entities(ENTITY_TYPES_18)
ENTITIES_15 = _entities(ENTITY_TYPES_15)
TOPICS = (
    "id string, created_at timestamp, categories map<string, double>, top_categories string"
)
KEYWORDS = "id string, created_at timestamp, keywords string"
EMBEDDINGS = "id string, embedding array<double>, created_at timestamp"
SUMMARY = "id string, summary string, created_at timestamp"
TITLE = "id string, title string, created_at timestamp"
STYLE = "id string, style string, created_at timestamp"
SEGMENTS = (
    "file_id string, file_url string, text string, segment_start double, "
    "segment_end double, segment_id int"
)
TRANSCRIPTS = (
    "source_url string, download_url string, created_at timestamp, "
    "transcription_json string, fulltext string, length_in_s int"
)
TRANSACTIONS = (
    "id string, created_at timestamp, data_size bigint, tag_app_agg string, "
    "owner_address string, is_bundle boolean, tags map<string, string>"
)
ENDPOINT_REGISTRY = (
    "gateways map<string, struct<settings: struct<protocol: string, fqdn: string>>>"
)
