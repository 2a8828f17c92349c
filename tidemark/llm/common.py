"""Helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_root

#: ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a table that may be copied to every executor, and bytes of their texts; more are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 20_000, 16 << 20
#: The same for a table of ids alone.
BROADCAST_IDS = 1_000_000
#: The setting, and Spark's default for it.
BATCH_BYTES, DEFAULT_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def on_workers(spark: SparkSession) -> None:
    """Prepare a session for work in Python workers.

    They import this library from where the driver has it, if they don't have it installed. Batches are
    bounded by bytes, as texts may be long, unless the session has a bound of its own.
    """
    if spark.conf.get(BATCH_BYTES) == DEFAULT_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, "4m")
    environment, here = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, here]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write the rows once to the folder all executors share and go on from there.

    Later steps neither compute them again nor depend on an executor that held them.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a table for broadcast if a count shows that its rows are few and its texts short.

    The table should be written already, as it is read for the count.
    """
    texts = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    found = df.agg(F.count("*"), *texts).first()
    return F.broadcast(df) if found[0] <= rows and sum(found[1:]) <= BROADCAST_BYTES else df


def keep_marked(docs: DataFrame, marks: DataFrame, by_content: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that stay by ``marks`` (doc_id, stays), which has a row for each of them.

    The texts aren't shuffled while the ids that go are few. Ids that are null or repeated don't tell rows
    apart: rows that have such an id, if there are any, are judged by ``by_content``.
    """
    ids = cut(marks.groupBy("doc_id").agg(F.count("*").alias("rows"), F.min("stays").alias("stays")))
    unclear = F.col("doc_id").isNull() | (F.col("rows") > 1)
    apart = ids.where(F.col("doc_id").isNotNull() & (unclear | ~F.col("stays"))).select("doc_id")
    clear = docs.where(F.col("doc_id").isNotNull()).join(small(apart, BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)
    strange = ids.where(unclear).select("doc_id")
    if strange.isEmpty():
        return clear
    (name,) = fresh(docs, "strange_id")
    strange = small(strange.toDF(name), BROADCAST_IDS)
    return clear.unionByName(by_content(docs.join(strange, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the frame doesn't have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: a fifth by the CRC-32 of the id, and rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that few texts are held as Python objects at once."""
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def by_batch(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str, rows: int = 1000) -> DataFrame:
    """Apply a function from a batch of at most so many rows to columns by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows):
                yield to_batch(function(part), arrow)
        pa.default_memory_pool().release_unused()

    arrow = arrow_schema(schema)
    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
        "array<float>": pa.list_(pa.float32()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [
        value if isinstance(value, pa.Array) else pa.array(value, type=field.type)
        for field, value in ((f, columns[f.name]) for f in schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
