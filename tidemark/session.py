"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import logging
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.files import Files

log = logging.getLogger(__name__)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library expects; a cluster's own settings win if given.

    Shuffle partitions are only a starting point: AQE merges small ones and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Loads that run side by side take turns.
        "spark.scheduler.mode": "FAIR",
        # A dimension of this size, as Spark estimates it, is worth a copy per executor.
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        # Files of a size worth opening; AQE still keeps all cores busy on small data.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
        # Keys inside the lag window are held on disk, not on the heap.
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only when the cluster names none, and Spark runs in one process, is a local folder used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), f"tidemark-{spark.sparkContext.applicationId}")


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; it does not exist yet, and is removed when the process ends."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(remove_scratch)
    _SCRATCH.append((spark, path))
    return path


def remove_scratch() -> None:
    """Remove the scratch folders of this process: results that are still read from them are gone then."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            Files(spark).remove(path)
        except Exception as error:  # the session may be gone
            log.debug("%s is left: %s", path, error)


def one_row(spark: SparkSession, **columns: Column) -> DataFrame:
    """A single row of expressions, which the optimizer evaluates while planning: no job runs."""
    return spark.sql("SELECT 1 AS one").select(*(c.alias(n) for n, c in columns.items()))


def broadcast_if_small(df: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """Mark a frame for broadcast if its rows, as counted, are few enough.

    Spark multiplies the sizes of the sides where it estimates a join, so a small result of joins looks
    huge and the other side of a further join is shuffled for nothing.
    """
    fixed = 16 + 8 * len(df.columns)
    texts = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    nested = any(kind.startswith(("array", "map", "struct", "variant")) for _, kind in df.dtypes)
    if nested:
        return df
    rows, *sizes = df.agg(F.count(F.lit(1)), *texts).first()
    return F.broadcast(df) if rows * fixed + sum(sizes) <= most_bytes else df


@contextmanager
def landed(df: DataFrame, label: str = "batch") -> Iterator[DataFrame]:
    """Write a batch once and read it back for as long as the block lasts.

    Everything in the block sees the same rows: a live source is not asked again, whether because
    two jobs need the batch or because an executor was lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        Files(spark).remove(path)
