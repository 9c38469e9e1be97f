"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A batch of 10,000 long texts takes gigabytes of every Python worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}

# Only possible before the session starts: no call site is recorded per column expression.
START_ONLY = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def get_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Shuffle partitions are left to the cluster: AQE coalesces a generous number.
    """
    builder = SparkSession.builder.appName("contentloom")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **START_ONLY, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the same on a session made elsewhere."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, which ``spark.checkpoint.dir`` names.

    Executors of a cluster do not see a temporary folder of the driver, so without the
    setting this fails there. Only a single-process session (tests, local runs) gets one.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share"
            )
        root = _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="contentloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; every run takes a new one."""
    return f"{scratch_root(spark)}/contentloom/{name}-{uuid.uuid4().hex[:12]}"


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh table name in a database that lives below the shared folder. The database is
    named after the folder, since a persistent catalog keeps it for sessions with another."""
    root = scratch_root(spark)
    database = f"contentloom_scratch_{hashlib.md5(root.encode()).hexdigest()[:8]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/{database}'")
    return f"{database}.{name}_{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise into the shared folder, so that a lost executor costs a re-read only."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The same rows from a table in the shared folder, which later jobs read by column."""
    table = scratch_table(df.sparkSession, name)
    df.write.format("parquet").options(**options).saveAsTable(table)
    return df.sparkSession.table(table)
