"""The wide metadata view."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from contentloom.functions.core import joined_concat
from contentloom.operators.keyed import latest_per_key
from contentloom.operators.refresh import KeyedView

# Entity columns that both extractors fill.
SHARED_ENTITIES = (
    "person", "norp", "fac", "org", "gpe", "loc", "product", "event", "work_of_art", "law",
)


def wide_metadata(
    content: DataFrame,
    entities_11: DataFrame,
    entities_18: DataFrame,
    keywords: DataFrame,
    topics: DataFrame,
) -> DataFrame:
    """Content left-joined to its enrichment rows.

    An enrichment table may hold several rows per id; the newest one counts. All joins
    use ``id``, so the content is shuffled once and stays in place for the four joins.
    """
    def newest(table: DataFrame) -> DataFrame:
        return latest_per_key(table, ["id"], ["created_at"])

    se = newest(entities_11).select(
        "id", *[F.col(f"{e}_entities").alias(f"_se_{e}") for e in SHARED_ENTITIES]
    )
    fe = newest(entities_18).select(
        "id", "date_entities",
        *[F.col(f"{e}_entities").alias(f"_fe_{e}") for e in SHARED_ENTITIES],
    )
    kw = newest(keywords).select("id", "keywords")
    tp = newest(topics).select(
        "id", F.col("top_categories").alias("top_category"), "categories"
    )
    joined = (
        content.join(fe, "id", "left")
        .join(se, "id", "left")
        .join(kw, "id", "left")
        .join(tp, "id", "left")
    )
    as_json = {"tags", "languages", "ngram_min_hash"}
    return joined.select(
        *[
            F.to_json(c).alias(c) if c in as_json else F.col(c)
            for c in content.columns
        ],
        *[
            joined_concat(",", f"_se_{e}", f"_fe_{e}").alias(f"{e}_entities")
            for e in SHARED_ENTITIES
        ],
        F.coalesce("date_entities", F.lit("")).alias("date_entities"),
        F.coalesce("top_category", F.lit("")).alias("top_category"),
        F.to_json("categories").alias("categories"),
        F.coalesce("keywords", F.lit("")).alias("keywords"),
    )


#: Source tables of the stored view, by their roles in ``wide_metadata``.
WIDE_SOURCES = ("content", "entities_11", "entities_18", "keywords", "topics")


def wide_view(target: str, tables: Mapping[str, str], parts: int) -> KeyedView:
    """The wide view as a stored table over the stored content and enrichment tables.

    ``refresh`` then joins what these tables have gained since the last time, instead of
    enriching or joining the corpus again.
    """
    missing = set(WIDE_SOURCES) - set(tables)
    if missing:
        raise ValueError(f"no table named for {sorted(missing)}")
    sources = {name: tables[name] for name in WIDE_SOURCES}
    return KeyedView(target, "id", "content", sources, lambda f: wide_metadata(**f), parts)
