"""Secret scan with corpus-wide ownership of the candidates, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from contentloom.llm.common import materialize

# The base kinds in their order, each with its pattern.
BASE_PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
}
ASSIGN_VALUE_CHARS = 8
#: Long runs with letters and digits: kept where the corpus shows one owner only.
WIDE_PATTERN = r"[A-Za-z0-9+/_-]{20,}"
WIDE_KIND = "owned"
KINDS = [*BASE_PATTERNS, WIDE_KIND]
#: From so many owners, or so many repositories of whatever owners, on, a value is a widely
#: copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 10


def _hits(kind: str, text: Column) -> Column:
    """The matches of one pattern in order: characters between the last match and this one,
    length, whether it counts, and the hash of the value.

    ``split`` gives the text between the matches, so its lengths give their places. A text
    without a match is scanned once.
    """
    pattern = BASE_PATTERNS.get(kind, WIDE_PATTERN)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def hit(pair: Column, i: Column) -> Column:
        match = pair["0"]
        value, valid = match, F.lit(True)
        if kind == "assign":
            value = F.regexp_extract(match, pattern, 2)
            valid = F.length(value) >= ASSIGN_VALUE_CHARS
        elif kind == WIDE_KIND:
            valid = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
        return F.struct(
            F.lit(KINDS.index(kind)).alias("k"),
            i.alias("i"),
            pair["1"].alias("gap"),
            F.length(match).alias("len"),
            valid.alias("valid"),
            F.when(valid, F.sha2(value, 256)).alias("hash"),
        )

    pairs = F.filter(F.arrays_zip(matches, gaps), lambda pair: pair["0"].isNotNull())
    return F.when(text.rlike(pattern), F.transform(pairs, hit)).otherwise(F.array())


def scan(docs: DataFrame, text_col: str, owner_col: str, repo_col: str, keep: list[str]) -> DataFrame:
    """One written row per document: ``_row``, ``_owner``, ``_repo``, ``_hits`` and the
    columns to keep under ``_keep_*``. The row number is fixed by the writing."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    hits = F.concat(*[_hits(kind, F.col("_text")) for kind in KINDS])
    return materialize(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(f"`{owner_col}`").alias("_owner"),
            F.col(f"`{repo_col}`").alias("_repo"),
            text.alias("_text"),
            *[F.col(f"`{c}`").alias(f"_keep_{c}") for c in keep],
        ).select("_row", "_owner", "_repo", hits.alias("_hits"), *[f"_keep_{c}" for c in keep]),
        "secrets",
    )


def candidate_spans(scanned: DataFrame) -> DataFrame:
    """_row, _owner, _repo, k, start, end, hash of every candidate. Windows hold the matches
    of one document."""
    order = Window.partitionBy("_row", "k").orderBy("i")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum("gap").over(upto) + F.coalesce(F.sum("len").over(before), F.lit(0))
    return (
        scanned.filter(F.size("_hits") > 0)
        .select("_row", "_owner", "_repo", F.inline("_hits"))
        .withColumn("start", start)
        .filter("valid")
        .select(
            "_row", "_owner", "_repo", "k", "start", (F.col("start") + F.col("len")).alias("end"), "hash"
        )
    )


def ownership(
    candidates: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS
) -> DataFrame:
    """hash, n_repos, n_owners, class of every candidate value of the corpus.

    ``example``: at least ``example_owners`` owners or ``example_repos`` repositories have it,
    be these of one owner; ``live``: one owner has it, in fewer repositories; ``shared``:
    between. Missing owners count as one. A value that a third of all documents
    hold is counted in three steps that each combine before they shuffle.
    """
    return (
        candidates.select("hash", "_owner", "_repo")
        .distinct()
        .groupBy("hash", "_owner")
        .agg(F.count("*").alias("n"))
        .groupBy("hash")
        .agg(F.sum("n").alias("n_repos"), F.count("*").alias("n_owners"))
        .withColumn(
            "class",
            F.when((F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos), "example")
            .when(F.col("n_owners") == 1, "live")
            .otherwise("shared"),
        )
    )


def classified_spans(candidates: DataFrame, owners: DataFrame) -> DataFrame:
    """_row, k, start, end, hash, class, n_owners, n_repos: all base spans, and those wide ones that are live
    and touch no base span of their document.

    Joining values to their owners splits a hot value by adaptive skew handling, since both
    sides are plain shuffles.
    """
    wide = F.col("k") == KINDS.index(WIDE_KIND)
    order = Window.partitionBy("_row").orderBy("start", "k")
    left = F.max(F.when(~wide, F.col("end"))).over(
        order.rowsBetween(Window.unboundedPreceding, -1)
    )
    right = F.min(F.when(~wide, F.col("start"))).over(
        order.rowsBetween(1, Window.unboundedFollowing)
    )
    apart = (F.coalesce(left, F.lit(-1)) <= F.col("start")) & (
        F.coalesce(right, F.col("end")) >= F.col("end")
    )
    return (
        candidates.join(owners, "hash")
        .withColumn("_apart", apart)
        .filter(~wide | (F.col("_apart") & (F.col("class") == "live")))
        .select("_row", "k", "start", "end", "hash", "class", "n_owners", "n_repos")
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])
        ),
        ",",
    )


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str = "doc_id",
    keep: list[str] | None = None,
    example_owners: int = EXAMPLE_OWNERS,
    example_repos: int = EXAMPLE_REPOS,
) -> DataFrame:
    """Scan whole texts and judge every candidate by how many owners and repositories the
    corpus shows.

    One row per input row: id (and the columns of ``keep``), ``secret_spans`` (array of k,
    start, end, class, n_owners, n_repos by start and kind; code points, end exclusive), n_assign, n_access,
    n_hex, n_owned, n_example, base_sha256, spans. NULL text is empty; NULL owner or
    repository is a value of its own; repeated rows are judged each, and count as one
    repository; an empty table gives no rows; other columns are ignored.
    """
    scanned = scan(docs, text_col, owner_col, repo_col, list(dict.fromkeys([id_col, *(keep or [])])))
    candidates = candidate_spans(scanned)
    owners = ownership(candidates, example_owners, example_repos)
    count = lambda k: F.count_if(F.col("k") == KINDS.index(k)).alias(f"n_{k}")
    per_row = (
        classified_spans(candidates, owners)
        .groupBy("_row")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "k", "end", "class", "n_owners", "n_repos"))).alias("secret_spans"),
            *[count(k) for k in KINDS],
            F.count_if(F.col("class") == "example").alias("n_example"),
        )
    )
    none = F.array().cast(per_row.schema["secret_spans"].dataType)
    spans = F.coalesce(F.col("secret_spans"), none)
    base = F.filter(spans, lambda s: s["k"] != KINDS.index(WIDE_KIND))
    names = [c.removeprefix("_keep_") for c in scanned.columns if c.startswith("_keep_")]
    return scanned.join(per_row, "_row", "left").select(
        *[F.col(f"_keep_{c}").alias(c) for c in names],
        spans.alias("secret_spans"),
        *[
            F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
            for c in [*[f"n_{k}" for k in KINDS], "n_example"]
        ],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def redact(text: Column, spans: Column) -> Column:
    """Replace every span by its kind's placeholder; overlapping spans are replaced as one."""
    names = F.array(*[F.lit(f"<{k}-secret>") for k in KINDS])
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        between = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.when(fresh, F.concat(acc["out"], between, F.get(names, s["k"])))
            .otherwise(acc["out"])
            .alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    done = F.aggregate(spans, begin, step)
    rest = F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(done["out"], rest))
