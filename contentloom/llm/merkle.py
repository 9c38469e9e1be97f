"""Merkle manifest of a dataset: trees by group, proofs by a recursive climb."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from contentloom.llm.common import materialize
from contentloom.operators.lookup import lookup

#: Children of a node.
FANOUT = 8
#: Climbers that look up one copy of a node's row.
CLIMBERS = 256
#: The tree over the groups' roots.
TOP = -1
DIGEST = 32


def digest(data: Column) -> Column:
    """The 32 bytes of a sha256."""
    return F.unhex(F.sha2(data, 256))


def hex_text(digests: Column) -> Column:
    """One or more digests in a row, as lower-case hex."""
    return F.lower(F.hex(digests))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row's values, each ``-`` if NULL, else its UTF-8 byte count, ``:``, value."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*map(part, values)))


def positions(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` written in order, with ``pos`` (from 0) and ``n`` (rows) within their group.

    The rows are dealt to ranges and numbered there as they are written. A group that spans
    ranges goes on where the range before ends: one small row per range and group.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*group, *order]
    placed = materialize(
        rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()),
        name,
    )
    placed = placed.withColumn("_range", F.shiftright("_at", 33)).withColumn("_g", F.struct(F.lit(0), *group))
    counted = placed.groupBy("_range", "_g").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    of_group = Window.partitionBy("_g")
    before = of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        F.struct("_range", "_g").alias("_key"),
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(of_group).alias("n"),
        "_n",
    )
    keyed = placed.withColumn("_key", F.struct("_range", "_g"))
    numbered = lookup(keyed, starts, "_key", "_at", weight="_n")
    pos = (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos")
    return numbered.select(*rows.columns, pos, "n")


def _node(tree: Column | str, level: Column, idx: Column) -> Column:
    return F.struct(F.col(tree).cast("long").alias("tree") if isinstance(tree, str) else tree.cast("long").alias("tree"), level.cast("int").alias("level"), idx.cast("long").alias("idx"))


def _parents(level: DataFrame) -> DataFrame:
    """The next level of all trees that have more than one node: tree, idx, n (nodes of the
    level), w (climbers below), digest, digests (of the children, in order)."""
    joined = F.array_sort(F.collect_list(F.struct("idx", "digest")))
    grouped = (
        level.filter("n > 1")
        .groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("idx"), F.ceil(F.col("n") / FANOUT).alias("n"))
        .agg(F.sum("w").alias("w"), joined.alias("_children"))
    )
    digests = F.aggregate("_children", F.unhex(F.lit("")), lambda a, c: F.concat(a, c["digest"]))
    rows = grouped.withColumn("digests", digests)
    return rows.select("tree", "idx", "n", "w", digest(hex_text(F.col("digests"))).alias("digest"), "digests")


def grow(first: DataFrame, level: int) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """All levels above the nodes of ``first`` (which are of ``level``), each written, and
    the trees' roots (tree, digest, w)."""
    levels, roots, at = [], [first.filter("n = 1").select("tree", "digest", "w")], first
    widest = first.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        level, widest = level + 1, -(-widest // FANOUT)
        at = materialize(_parents(at), f"level_{level}")
        levels.append((level, at))
        roots.append(at.filter("n = 1").select("tree", "digest", "w"))
    return levels, reduce(DataFrame.union, roots)


def parent_links(levels: list[tuple[int, DataFrame]], groups: int) -> DataFrame:
    """One row per node: node, parent, slot (place among its siblings), w, digests.

    The parent of a tree's root is a node of the top tree if there are several trees.
    """
    rows = reduce(
        DataFrame.unionByName,
        [t.select(_node("tree", F.lit(level), F.col("idx")).alias("node"), "n", "w", "digests") for level, t in levels],
    )
    tree, level, idx = (F.col(f"node.{c}") for c in ("tree", "level", "idx"))
    inner, rooted = F.col("n") > 1, (tree != TOP) & F.lit(groups > 1)
    up = F.when(inner, _node(tree, level + 1, F.floor(idx / FANOUT))).when(
        rooted, _node(F.lit(TOP), F.lit(1), F.floor(tree / FANOUT))
    )
    slot = F.when(inner, idx % FANOUT).when(rooted, tree % FANOUT).cast("int")
    return rows.select("node", up.alias("parent"), slot.alias("slot"), "w", "digests")


def _copies(w: Column) -> Column:
    return F.ceil(w / CLIMBERS)


CLIMB = """
WITH RECURSIVE climb (run, parent, slot, copies, folded, rest) AS (
  SELECT run, parent, slot, copies, folded, rest FROM {runs}
  UNION ALL
  SELECT c.run, n.parent, n.slot, n.copies,
    transform(c.folded, f -> unhex(sha2(lower(hex(concat(
      substring(n.digests, 1, {digest} * c.slot), f, substring(n.digests, {digest} * c.slot + {digest} + 1)
    ))), 256))),
    concat(c.rest, substring(n.digests, 1, {digest} * c.slot), substring(n.digests, {digest} * c.slot + {digest} + 1))
  FROM climb c JOIN {nodes} n
    ON n.node = c.parent AND n.copy = pmod(xxhash64(c.run), c.copies)
)
SELECT run, folded, rest FROM climb WHERE parent IS NULL
"""


def climb(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """run, folded (the root as each leaf of the run gives it), rest (siblings met above it).

    ``runs`` has run, parent, slot, copies, folded and rest of the climbers; ``nodes`` has
    node, copy, parent, slot, copies and digests. All leaves of a run meet the same
    siblings above it, so they climb as one row. A step joins every climber to its parent.
    """
    spark = runs.sparkSession
    views = {"digest": DIGEST}
    for name, table in (("runs", runs), ("nodes", nodes)):
        table.createOrReplaceTempView(f"_merkle_{name}")
        views[name] = f"_merkle_{name}"
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return materialize(spark.sql(CLIMB.format(**views)), "climbed")
    finally:
        spark.conf.set(limit, before)
        for name in ("runs", "nodes"):
            spark.catalog.dropTempView(views[name])


def merkle_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    *,
    altered: dict[str, Column] | None = None,
) -> DataFrame:
    """The manifest's digests of every row, and whether the row as it is now still gives them.

    A leaf is the digest of the row's ``fields``. Leaves of a group ascend by id (NULL
    first, equal ids by leaf); every eight nodes in a row become their parent until one is
    left, the group's root. The groups' roots in order of the group (NULL first) become the
    root likewise. ``altered`` gives the current values of fields that may have changed.

    One row per input row: the id, leaf, subroot, root and proof_sha256 (over the siblings
    from leaf to root, left to right) of the rows as stored, folded_root (the root that the
    current row gives with the stored siblings), verified. Repeated rows are a leaf each; an
    empty table gives no rows; other columns are ignored. Every written level is a table of
    nodes that name their parent. Digests are bytes inside and hex text in the result.
    """
    spark: SparkSession = docs.sparkSession
    stored = [F.col(f"`{c}`") for c in fields]
    now = [(altered or {}).get(c, F.col(f"`{c}`")) for c in fields]
    changed = reduce(Column.__or__, [~a.eqNullSafe(b) for a, b in zip(now, stored, strict=True)])
    leaf = leaf_digest(stored)
    leaves = docs.select(
        F.col(f"`{group_col}`").alias("g"),
        F.col(f"`{id_col}`").alias("id"),
        leaf.alias("leaf"),
        (F.when(changed, leaf_digest(now)) if altered else F.lit(None).cast("binary")).alias("now"),
    )
    leaves = positions(leaves, ["g"], ["id", "leaf"], "leaves")
    groups = positions(leaves.select("g").distinct(), [], ["g"], "groups").select(
        F.struct("g").alias("g"), F.col("pos").alias("tree")
    )
    placed = lookup(leaves.withColumn("g", F.struct("g")), groups, "g", "leaf")
    n_groups = groups.count()

    member = F.struct((F.col("pos") % FANOUT).cast("int").alias("slot"), "id", "leaf", F.coalesce("now", "leaf").alias("now"))
    digests = F.aggregate("members", F.unhex(F.lit("")), lambda a, m: F.concat(a, m["leaf"]))
    runs = (
        placed.groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("idx"), "n")
        .agg(F.array_sort(F.collect_list(member)).alias("members"))
        .withColumn("digests", digests)
    )
    alone = F.col("n") == 1
    runs = materialize(
        runs.select(
            "tree",
            "idx",
            F.ceil(F.col("n") / FANOUT).alias("n"),
            F.lit(1).cast("long").alias("w"),
            F.when(alone, F.col("digests")).otherwise(digest(hex_text(F.col("digests")))).alias("digest"),
            "digests",
            "members",
        ),
        "level_1",
    )
    above, subroots = grow(runs, 1)
    subroots = materialize(subroots, "subroots")
    top, roots = grow(
        subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n_groups).cast("long").alias("n"), "w", "digest"), 0
    )
    root = roots.first()

    links = materialize(parent_links([(1, runs), *above, *top], n_groups), "links")
    weights = links.select(F.col("node").alias("parent"), _copies(F.col("w")).alias("copies"))
    nodes = links.join(weights, "parent", "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(0).cast("long"), _copies(F.col("w")) - 1))
    )
    nodes = materialize(nodes.select("node", "copy", "parent", "slot", "copies", "digests"), "nodes")

    run = _node("tree", F.lit(1), F.col("idx")).alias("run")
    around = lambda d, m: (
        F.substring(d, F.lit(1), m["slot"] * DIGEST),
        F.substring(d, m["slot"] * DIGEST + (DIGEST + 1), F.lit(FANOUT * DIGEST)),
    )

    def fold(member: Column) -> Column:
        before, after = around(F.col("digests"), member)
        lone = (F.size("members") == 1) & (F.col("n") == 1)  # a lone leaf is its group's root
        return F.when(lone, member["now"]).otherwise(digest(hex_text(F.concat(before, member["now"], after))))

    starts = runs.select(run, F.transform("members", fold).alias("folded"))
    first = nodes.filter("copy = 0").select(F.col("node").alias("run"), "parent", "slot", "copies")
    climbers = materialize(
        starts.join(first, "run").withColumn("rest", F.unhex(F.lit(""))), "climbers"
    )
    climbed = climb(climbers, nodes)

    each = (
        runs.select(run, "tree", "digests", "members")
        .join(climbed, "run")
        .select("tree", "digests", "rest", F.inline(F.arrays_zip("members", "folded")))
        .select("tree", "digests", "rest", "folded", "members.*")
    )
    named = lookup(each, subroots.select("tree", F.col("digest").alias("subroot")), "tree", "leaf", materialized=True)
    siblings = around(F.col("digests"), {"slot": F.col("slot")})
    root_hex = F.lit(root.digest.hex() if root else None).cast("string")
    return named.select(
        F.col("id").alias(id_col),
        hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        root_hex.alias("root"),
        F.sha2(hex_text(F.concat(*siblings, F.col("rest"))), 256).alias("proof_sha256"),
        hex_text(F.col("folded")).alias("folded_root"),
        (hex_text(F.col("folded")) == root_hex).alias("verified"),
    )
