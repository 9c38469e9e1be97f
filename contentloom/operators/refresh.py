"""Views over keyed tables that are kept up to date by rewriting what has changed."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contentloom.operators.lookup import fits_broadcast
from contentloom.session import cut_lineage
from contentloom.sources.tables import Layout, overwrite_partitions, rebuild_and_swap

PART = "part"


def part_of(key: str, parts: int) -> Column:
    """The partition of a key, the same in every table that uses it."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def write_parted(df: DataFrame, table: str, key: str, parts: int) -> None:
    """Create a table whose partitions are hash classes of the key."""
    dealt = df.withColumn(PART, part_of(key, parts)).repartition(PART)
    dealt.write.format("parquet").partitionBy(PART).saveAsTable(table)


@dataclass(frozen=True)
class KeyedView:
    """A stored view with one row per key of the ``leading`` source.

    ``sources`` names the stored tables it reads. ``build`` makes the view's rows from them,
    each key's rows from the sources' rows of that key alone. Sources with a column ``part``
    must be partitioned by it like the target.
    """

    target: str
    key: str
    leading: str
    sources: Mapping[str, str]
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    parts: int = 64

    @property
    def marks(self) -> str:
        return f"{self.target}_marks"


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: ``built``, ``rebuilt``, ``refreshed`` or ``unchanged``, for how many
    keys, rewriting how many partitions."""

    mode: str
    keys: int = 0
    partitions: int = 0


def _files(spark: SparkSession, view: KeyedView) -> dict[str, set[str]]:
    found = {}
    for name, table in view.sources.items():
        spark.catalog.refreshTable(table)
        found[name] = set(spark.table(table).inputFiles())
    return found


def _mark(spark: SparkSession, view: KeyedView, files: dict[str, set[str]]) -> None:
    rows = [(name, f) for name, fs in files.items() for f in sorted(fs)]
    marks = spark.createDataFrame(rows, "source string, file string").coalesce(1)
    if spark.catalog.tableExists(view.marks):
        rebuild_and_swap(marks, view.marks)
    else:
        marks.write.format("parquet").saveAsTable(view.marks)


def _rows(view: KeyedView, frames: Mapping[str, DataFrame]) -> DataFrame:
    plain = {name: df.drop(PART) for name, df in frames.items()}
    return view.build(plain).withColumn(PART, part_of(view.key, view.parts))


def _build(spark: SparkSession, view: KeyedView, files: dict[str, set[str]], mode: str) -> Refresh:
    rows = _rows(view, {name: spark.table(t) for name, t in view.sources.items()}).repartition(PART)
    if spark.catalog.tableExists(view.target):
        rebuild_and_swap(rows, view.target, Layout(partition_by=(PART,)))
    else:
        rows.write.format("parquet").partitionBy(PART).saveAsTable(view.target)
    _mark(spark, view, files)
    built = spark.table(view.target)
    return Refresh(mode, built.count(), built.select(PART).distinct().count())


def _changed_keys(spark: SparkSession, view: KeyedView, new: dict[str, set[str]]) -> DataFrame:
    """Keys of the leading source with a row in a new file of any source."""
    read = []
    for name, files in new.items():
        if files:
            kind = spark.table(view.sources[name]).schema[view.key].dataType
            rows = spark.read.schema(f"`{view.key}` {kind.simpleString()}").parquet(*sorted(files))
            read.append(rows.select(view.key))
    keys = reduce(DataFrame.union, read).filter(F.col(view.key).isNotNull()).distinct()
    leading = spark.table(view.sources[view.leading]).select(view.key)
    known = leading.join(F.broadcast(keys) if fits_broadcast(keys) else keys, view.key, "left_semi").distinct()
    return cut_lineage(known.withColumn(PART, part_of(view.key, view.parts)))


def refresh(spark: SparkSession, view: KeyedView) -> Refresh:
    """Bring the target up to date with its sources.

    The marks name the source files that the target already shows. Only keys that occur in
    other files are made anew, from the sources' partitions that hold them, and only these
    partitions of the target are rewritten. Rows that arrive late, with whatever time stamp,
    count by their file. A source that has lost files was rewritten, so the view is built
    anew. A run that dies before the marks are written is repeated by the next one, with the
    same result. Without new files nothing is read or written.
    """
    files = _files(spark, view)
    if not (spark.catalog.tableExists(view.target) and spark.catalog.tableExists(view.marks)):
        return _build(spark, view, files, "built")
    seen: dict[str, set[str]] = {name: set() for name in view.sources}
    for r in spark.table(view.marks).collect():
        seen.setdefault(r["source"], set()).add(r["file"])
    if any(seen[name] - files.get(name, set()) for name in seen):
        return _build(spark, view, files, "rebuilt")
    new = {name: files[name] - seen[name] for name in files}
    if not any(new.values()):
        return Refresh("unchanged")
    changed = _changed_keys(spark, view, new)
    touched = sorted(r[0] for r in changed.select(PART).distinct().collect())
    if touched:
        keys = changed.select(view.key)
        keys = F.broadcast(keys) if fits_broadcast(changed) else keys

        def of_changed(df: DataFrame, how: str) -> DataFrame:
            rows = df.filter(F.col(PART).isin(touched)) if PART in df.columns else df
            return rows.join(keys, view.key, how)

        made = _rows(view, {n: of_changed(spark.table(t), "left_semi") for n, t in view.sources.items()})
        target = spark.table(view.target)
        merged = of_changed(target, "left_anti").unionByName(made.select(*target.columns))
        overwrite_partitions(merged.repartition(PART), view.target)
    _mark(spark, view, files)
    return Refresh("refreshed", changed.count(), len(touched))
