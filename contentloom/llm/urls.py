"""URL filter: curated rules, then association rules mined from labels. DataFrame functions
and Spark's own FP-growth only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from contentloom.llm.common import ascii_lower, materialize

# The curated rules (verdict, host, path).
CURATED = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Number of the labelled pages that a rule must be right on, however many there are, and
#: share of its pages that must be bad.
MIN_PAGES, MIN_CONFIDENCE = 20, 0.5
BAD = "=bad"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def curated_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_items(url: Column, host: Column, path: Column) -> Column:
    """The tokens of a URL: scheme, every label and every suffix domain of the host, every
    path segment, file type, every query key, fragment; each once, digits as 0."""

    def tokens(kind: str, values: Column) -> Column:
        values = F.transform(values, lambda v: F.regexp_replace(ascii_lower(v), F.lit("[0-9]+"), F.lit("0")))
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(f"{kind}:"), v))

    labels = F.filter(F.split(host, "[.]"), lambda x: x != "")
    domains = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    found = F.concat(
        tokens("scheme", F.array(F.regexp_extract(url, "^([A-Za-z]+)://", 1))),
        tokens("label", labels),
        tokens("domain", domains),
        tokens("path", F.split(path, "/")),
        tokens("type", F.array(F.regexp_extract(path, "[.]([A-Za-z0-9]{1,5})$", 1))),
        tokens("query", F.regexp_extract_all(url, F.lit("[?&]([^=&#]+)"), F.lit(1))),
        F.when(url.contains("#"), F.array(F.lit("fragment:"))).otherwise(F.array()),
    )
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def token_classes(labelled: DataFrame, min_pages: int) -> DataFrame:
    """item, class, sure: the tokens of at least ``min_pages`` bad pages, which all tokens of a
    rule are.

    Tokens of the same labelled pages are one class, as a rule with two of them is no surer
    than with either one. A ``sure`` class is on bad pages only, so that a rule with it and
    others is no surer than itself. All three lose no rule and keep the combinations few.
    """
    rows = labelled.select("_row", "bad", F.explode("items").alias("item"))
    pages = [F.bit_xor(F.xxhash64("_row", F.lit(i))).alias(f"h{i}") for i in range(2)]
    counted = rows.groupBy("item").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), *pages)
    same = counted.filter(F.col("n_bad") >= min_pages).groupBy("n", "h0", "h1")
    classes = same.agg(
        F.min("item").alias("class"), F.collect_list("item").alias("members"), F.first("n_bad").alias("n_bad")
    )
    sure = F.col("n_bad") == F.col("n")
    return materialize(classes.select(F.explode("members").alias("item"), "class", sure.alias("sure")), "tokens")


def in_classes(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """``pages`` (with ``_row``) whose ``items`` are the classes of their tokens."""
    classes = classes.select("item", "class")
    columns = [c for c in pages.columns if c != "items"]
    tokens = pages.select(*columns, F.explode_outer("items").alias("item"))
    return tokens.join(classes, "item", "left").groupBy(*columns).agg(F.collect_set("class").alias("items"))


def sure_rules(classes: DataFrame) -> DataFrame:
    """rule_items, confidence, key: the rule of every class that is on bad pages only."""
    sure = classes.filter("sure").select(F.col("class").alias("key")).distinct()
    return sure.select(F.array("key").alias("rule_items"), F.lit(1.0).alias("confidence"), "key")


def mine_rules(
    baskets: DataFrame, min_support: float, min_pages: int, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """rule_items, confidence, key: rules "these classes, therefore bad".

    ``baskets`` has ``items`` and ``bad``. A rule goes if leaving out one of its classes
    gives a rule that is at least as sure. ``key`` is the rule's rarest class.
    """
    marked = F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support).fit(baskets.select(marked.alias("items")))
    sets = materialize(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    right = sets.filter(F.array_contains("items", BAD) & (F.size("items") > 1) & (F.col("freq") >= min_pages))
    right = right.select(F.array_remove("items", BAD).alias("rule_items"), F.col("freq").alias("right"))
    counted = right.join(sets.withColumnRenamed("items", "rule_items"), "rule_items")
    rules = counted.select("rule_items", (F.col("right") / F.col("freq")).alias("confidence"))
    rules = materialize(rules.filter(F.col("confidence") >= min_confidence), "rules")
    smaller = rules.select(F.col("rule_items").alias("parent"), F.col("confidence").alias("surer"))
    redundant = (
        rules.select("rule_items", "confidence", F.explode("rule_items").alias("item"))
        .withColumn("parent", F.array_remove("rule_items", F.col("item")))
        .join(smaller, "parent")
        .filter("surer >= confidence")
        .select("rule_items")
        .distinct()
    )
    single = sets.filter(F.size("items") == 1).select(F.get("items", F.lit(0)).alias("item"), "freq")
    kept = rules.join(redundant, "rule_items", "left_anti")
    rarest = (
        kept.select("rule_items", F.explode("rule_items").alias("item"))
        .join(single, "item")
        .groupBy("rule_items")
        .agg(F.min_by("item", F.struct("freq", "item")).alias("key"))
    )
    return materialize(kept.join(rarest, "rule_items"), "rules")


def match_rules(pages: DataFrame, classes: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` (with ``items``) and ``confidence``: that of the surest rule that fits, else NULL.

    The rules are an inverted index under their rarest class: a page looks up its classes and
    keeps the rules whose other classes it has as well. Spark broadcasts the index after its
    own check of the size, and otherwise splits hot classes of the join.
    """
    columns = [c for c in pages.columns if c != "items"]
    looked_up = (
        in_classes(pages.withColumn("_row", F.monotonically_increasing_id()), classes)
        .withColumn("key", F.explode_outer("items"))
        .join(rules.select("key", "rule_items", "confidence"), "key", "left")
    )
    fits = F.size(F.array_except("rule_items", "items")) == 0
    return looked_up.groupBy("_row", *columns).agg(
        F.max(F.when(fits, F.col("confidence"))).alias("confidence")
    ).drop("_row")


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    bad: Column,
    id_col: str = "page_id",
    url_col: str = "url",
    label_id_col: str = "doc_id",
    *,
    rules: Sequence[tuple[str, str, str]] = CURATED,
    min_pages: int = MIN_PAGES,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Judge every URL by the longest curated rule, else by the mined ones.

    ``bad`` is a condition on ``labels``, whose ids are those of the pages. One row per input
    row: id, host, path, rule, verdict, confidence (of the surest mined rule, where no
    curated one fits). A NULL or malformed URL has empty host and path and no tokens, so it
    is allowed; a NULL label counts as good; labels without page or id teach nothing, and
    repeated ones count each; without labels nothing is mined; other columns are ignored; an
    empty table gives no rows.
    """
    url = F.col("_url")
    parsed = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_url")).select(
        "_id", "_url", host_of(url).alias("host"), path_of(url).alias("path")
    )
    items = url_items(url, F.col("host"), F.col("path"))
    taught = (
        parsed.filter("_url IS NOT NULL")
        .join(labels.select(F.col(f"`{label_id_col}`").alias("_id"), F.coalesce(bad, F.lit(False)).alias("bad")), "_id")
        .select(F.monotonically_increasing_id().alias("_row"), items.alias("items"), "bad")
    )
    taught = materialize(taught, "labelled_urls")
    classes = token_classes(taught, min_pages)
    support = min(1.0, (min_pages - 0.5) / max(taught.count(), 1))  # rounded up to pages
    baskets = in_classes(taught, classes.filter("NOT sure"))
    mined = mine_rules(baskets, support, min_pages, min_confidence).unionByName(sure_rules(classes))
    ruled = parsed.withColumn("_rule", curated_rule(F.col("host"), F.col("path"), rules))
    by_rule = ruled.filter("_rule IS NOT NULL").select(
        "_id", "host", "path", "_rule.rule", "_rule.verdict", F.lit(None).cast("double").alias("confidence")
    )
    rest = ruled.filter("_rule IS NULL").select("_id", "host", "path", items.alias("items"))
    by_method = match_rules(rest, classes, mined).select(
        "_id",
        "host",
        "path",
        F.lit(None).cast("string").alias("rule"),
        F.when(F.col("confidence").isNotNull(), "block").otherwise("allow").alias("verdict"),
        "confidence",
    )
    return by_rule.union(by_method).withColumnRenamed("_id", id_col)
