"""Incremental views. Every start continues from its checkpoint and stops when the input
that is present has been read, so a scheduler can run it as often as it likes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from contentloom.operators.keyed import latest_per_key
from contentloom.session import scratch_path


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    name_pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New parquet files of a folder; ``name_pattern`` picks files by name."""
    reader = spark.readStream.schema(schema)
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_to_table(
    stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append"
) -> StreamingQuery:
    """Process what is there into a parquet folder, exactly once per input file."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_updates_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The same for a stream of updates. A batch has its own folder, which it replaces when it
    is repeated after a failure."""

    def on_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def materialize(
    stream: DataFrame, name: str, output: T.StructType | str | None = None
) -> DataFrame:
    """Run a stream into a new folder and read the result back."""
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    run_to_table(stream, f"{base}/data", f"{base}/checkpoint")
    return spark.read.schema(output or stream.schema).parquet(f"{base}/data")


def tracker(payload_stream: DataFrame, index: DataFrame) -> DataFrame:
    """Each newly cached payload joined to its index row (stream-static join)."""
    return payload_stream.select("id", "retrieved_at").join(index, "id").select(
        "id", "created_at_dt", "created_at", "app", "retrieved_at", "data_size"
    )


def tracker_with_late_index(payloads: DataFrame, index: DataFrame, delay: str) -> DataFrame:
    """Each newly cached payload with its index row, whichever of the two comes first.

    Both are streams: payloads have ``retrieved_at``, index rows ``indexed_at``, their times of
    arrival, which may differ by up to ``delay``. A side waits in the state for its partner; a
    payload without one is emitted with empty index columns when the watermark has passed
    its time. State older than the delay is dropped.
    """
    p = payloads.select("id", F.col("retrieved_at").cast("timestamp").alias("retrieved_at"))
    i = index.withColumn("indexed_at", F.col("indexed_at").cast("timestamp")).withColumnRenamed("id", "index_id")
    p, i = p.withWatermark("retrieved_at", delay), i.withWatermark("indexed_at", delay)
    apart = F.expr(f"INTERVAL {delay}")
    near = F.col("indexed_at").between(F.col("retrieved_at") - apart, F.col("retrieved_at") + apart)
    return p.join(i, (F.col("id") == F.col("index_id")) & near, "left_outer").select(
        "id", "created_at_dt", "created_at", "app", "retrieved_at", "data_size"
    )


class NewestRow(StatefulProcessor):
    """Keeps the newest row of a key, and passes a row on if it replaces the kept one."""

    def __init__(self, schema: T.StructType, order: Sequence[str], ttl_ms: int) -> None:
        self.schema, self.order, self.ttl_ms = schema, list(order), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", self.schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        at = [self.schema.fieldNames().index(c) for c in self.order]
        kept = self.newest.get()
        best = tuple(kept) if kept is not None else None
        fresh = False
        for row in map(tuple, rows):
            if best is None or tuple(row[i] for i in at) > tuple(best[i] for i in at):
                best, fresh = row, True
        if fresh:
            self.newest.update(best)
            yield Row(**dict(zip(self.schema.fieldNames(), best, strict=True)))

    def close(self) -> None:
        pass


def newest_changes(stream: DataFrame, keys: Sequence[str], order: Sequence[str], ttl: dt.timedelta) -> DataFrame:
    """Rows that are newer than all rows of their key before, at most one per key and batch.

    The state has one row per key, in RocksDB below the checkpoint, and survives a restart;
    a key without news for ``ttl`` is forgotten. Rows whose order columns are NULL are left out.
    """
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in order])
    # Times with a zone are kept as microseconds: rows and state hand them out differently.
    zoned = [f.name for f in stream.schema if isinstance(f.dataType, T.TimestampType)]
    plain = stream.filter(whole).withColumns({c: F.unix_micros(c) for c in zoned})
    processor = NewestRow(plain.schema, order, int(ttl.total_seconds() * 1000))
    changes = plain.groupBy(*keys).transformWithState(processor, plain.schema, "Update", "ProcessingTime")
    return changes.withColumns({c: F.timestamp_micros(c) for c in zoned})


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """For streams with a state per key that forgets by the clock: the state is kept in
    RocksDB, and no batch runs without new files, else a run would wait for the clock."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def transformed(stream: DataFrame, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The batch transform applied to a stream: back-fill and increments share it."""
    return transform(stream)


def first_seen(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key; state older than the delay is dropped."""
    event_time = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return event_time.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def keyed_replace_stream(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    merge: Callable[[DataFrame], None],
    checkpoint: str,
) -> StreamingQuery:
    """Newest row per key under repeated loads: each micro-batch is reduced to one row per
    key and handed to ``merge``, which must be idempotent (a keyed replace is)."""
    def on_batch(batch: DataFrame, _epoch: int) -> None:
        merge(latest_per_key(batch, keys, order))

    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def daily_counts(stream: DataFrame, ts: str, actor: str, delay: str, *by: Column | str) -> DataFrame:
    """Rows and approximate distinct actors per day."""
    event_time = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        event_time.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day"), *by)
        .agg(F.count("*").alias("n"), F.approx_count_distinct(actor).alias("actors"))
        .select(F.col("window.start").alias("day"), *by, "n", "actors")
    )
