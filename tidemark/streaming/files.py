"""Incremental ingest of files as a stream: Spark's checkpoint keeps the position.

``dedup_within`` keeps keys as state for as long as the watermark says; ``into_table`` keeps none and upserts
every micro-batch into a table, once per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.scalars import field_type, literal
from tidemark.operators.incremental import apply_lag, since
from tidemark.operators.merge import key_list, one_row_per_key
from tidemark.sinks.tables import Table
from tidemark.streaming.ledger import Ledger


def stream_files(spark: SparkSession, folder: str, schema: T.StructType | str, file_format: str = "parquet", **options):
    """New files of a folder, each once."""
    return spark.readStream.format(file_format).schema(schema).options(**options).load(folder)


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for a stream with state, as the number of its partitions is fixed by its first run.

    Without a number there is one partition per core.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return session


def dedup_within(stream: DataFrame, key: str | list[str], cursor: str, lag_seconds: int) -> DataFrame:
    """Each key of a stream once, as long as its copies are no more than the lag apart.

    The first row that arrives stays. Its key is held in the state store until the watermark, the highest
    cursor less the lag, has passed it by the lag; so state is bounded by the window, not by the stream.
    Rows behind the watermark, and rows without a cursor, are left out. A row without a key only equals
    rows that agree in everything.
    """
    names = key_list(key)
    keyed = F.lit(True)
    for name in names:
        keyed = keyed & F.col(name).isNotNull()
    at = F.col(cursor) if isinstance(field_type(stream, cursor), T.TimestampType) else F.col(cursor).try_cast("timestamp")
    whole = F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in stream.columns))), 256)
    marked = stream.withColumns({"_at": at, "_whole": F.when(~keyed, whole)}).where(F.col("_at").isNotNull())
    marked = marked.withWatermark("_at", f"{lag_seconds} seconds")
    return marked.dropDuplicatesWithinWatermark([*names, "_whole"]).drop("_at", "_whole")


def append_to(stream: DataFrame, folder: str) -> DataStreamWriter:
    """Parquet files, each batch once: Spark's file sink notes the batches in the folder itself."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", folder)


def behind(rows: DataFrame, cursor: str, mark) -> DataFrame:
    """Rows before the mark, and rows without a cursor: what ``since`` leaves out."""
    at_or_after = F.col(cursor) >= literal(mark, field_type(rows, cursor))
    return rows.where(~F.coalesce(at_or_after, F.lit(False)))


def land_batch(
    batch: DataFrame, batch_id: int, table: Table, key: str | list[str], cursor: str, lag_seconds: int, rejects: str, ledger: Ledger
) -> None:
    """Upsert one micro-batch, exactly once.

    What the batch is made into, its good rows and its rejects, is written before the table changes, and
    noted in the ledger. A batch that runs again after a crash goes on from there: it merges the same
    rows and leaves the same rejects, though the table's mark may have moved meanwhile. A batch that is
    done is skipped.
    """
    entry = ledger.entry(batch_id)
    if entry.reached("done"):
        return
    if not entry.reached("prepared"):
        mark = apply_lag(table.max_cursor(cursor), lag_seconds)
        if mark is not None:
            behind(batch, cursor, mark).write.mode("overwrite").parquet(f"{rejects}/_query_id={ledger.query}/_batch_id={batch_id}")
        entry.put(one_row_per_key(since(batch, cursor, mark), key, cursor))
        entry.note("prepared", None if mark is None else str(mark))
    newest = entry.rows()
    if table.exists() or newest.limit(1).count():
        table.merge(newest, key=key)
    entry.note("done")
    entry.clear()


def into_table(
    stream: DataFrame, table: Table, key: str | list[str], cursor: str, lag_seconds: int, rejects: str
) -> DataStreamWriter:
    """Upsert every micro-batch by key: of a key's rows in a batch the newest counts.

    Rows behind the table's high-water mark by more than the lag go to ``rejects``, one folder per batch.
    The ledger of batches lies within the table.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        ledger = Ledger(table.spark, f"{table.path}/_batches", query)
        land_batch(batch, batch_id, table, key, cursor, lag_seconds, rejects, ledger)

    return stream.writeStream.foreachBatch(land)


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process all files there are now, then stop; the next run goes on from there."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
