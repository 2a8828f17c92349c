"""SimHash near-duplicates, linked by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in at most two bits share a value within one bit of both. So every
distinct fingerprint emits itself and its 64 one-bit variants, the variants are shuffled, and those
fingerprints that meet under one variant are linked. At most 65 fingerprints can meet there, as copies
count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, by_batch, cut, fresh, keep_marked, table, text_of, to_batch

SHINGLE_WORDS = 3
SEED = 42
#: Fingerprints with at most so many differing bits are linked; every fingerprint moves half as far.
RADIUS = 2
LINK = "a long, b long"


def fingerprint(text: str | None) -> int:
    """The SimHash as a signed 64-bit number; zero for a text without words."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII case and white space only
    if not words:
        return 0
    k = min(SHINGLE_WORDS, len(words))
    joined, starts, ends, at = b" ".join(words), [], [], 0
    for word in words:
        starts.append(at)
        at += len(word)
        ends.append(at)
        at += 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :])), dtype="<u8", count=len(words) - k + 1
    )
    ones = np.zeros(64, dtype=np.int64)
    for part in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[part : part + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    over = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(over.view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "fp": [fingerprint(t) for t in batch.column("text").to_pylist()]}

    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, fp long")


def ball(fp: Column) -> Column:
    """All values within one bit."""
    return F.array(fp, *(fp.bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)))


def link_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in the order of (variant, fp): each fingerprint with the one before it under the same variant."""
    schema, last = arrow_schema(LINK), None
    for batch in batches:
        if not batch.num_rows:
            continue
        variant, fp = (batch.column(i).to_numpy() for i in (0, 1))
        if last is not None:
            variant, fp = np.concatenate(([last[0]], variant)), np.concatenate(([last[1]], fp))
        last = variant[-1], fp[-1]
        meet = np.flatnonzero(variant[1:] == variant[:-1])
        a, b = fp[meet], fp[meet + 1]
        near = (a != b) & (np.bitwise_count((a ^ b).view(np.uint64)) <= RADIUS)
        if near.any():
            yield to_batch({"a": a[near], "b": b[near]}, schema)


def links(distinct: DataFrame) -> DataFrame:
    """Links (a < b) that join the fingerprints of the column ``fp`` exactly as all near pairs do.

    All fingerprints under one variant are within the radius of each other, so a chain through them
    keeps every group together. Pairs found under several variants count once.
    """
    variants = distinct.select(F.explode(ball(F.col("fp"))).alias("variant"), "fp")
    return variants.repartition("variant").sortWithinPartitions("variant", "fp").mapInArrow(link_neighbours, LINK).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) of every fingerprint with a link; root is the smallest of its component.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones. The number of rounds grows with the logarithm of the longest path.
    """
    edges = cut(edges)
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = star(both, F.col("b") > F.col("a"))
        edges = star(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), F.lit(True))
        edges = cut(edges)
        new = edges.agg(
            F.count("*"),
            F.sum(F.col("a").cast("decimal(38,0)")),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
        if new == state:
            return edges.select(F.col("b").alias("fp"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("fp"), F.col("a").alias("root")).distinct()
            )
        state = new


def star(edges: DataFrame, chosen: Column) -> DataFrame:
    """Link the chosen neighbours b of each node a, and the node itself, to the smallest of a and its neighbours."""
    low = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).withColumn("low", F.least("low", "node"))
    moved = edges.where(chosen).join(low, F.col("a") == F.col("node")).select(F.col("low").alias("a"), "b")
    own = low.select(F.col("low").alias("a"), F.col("node").alias("b"))
    return moved.unionByName(own).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def roots(prints: DataFrame) -> DataFrame:
    """From (doc_id, fp): per distinct fp its root, the component's smallest id, and how many rows have that id."""
    prints = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    prints = cut(prints)
    found = components(links(prints)).withColumnRenamed("fp", "linked")
    rooted = prints.join(found, F.col("fp") == F.col("linked"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    rooted = cut(rooted)
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(lows, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``docs`` (doc_id, text).

    A text without words, or null, has the fingerprint zero and is linked like any other. A component
    whose rows all lack an id has none. Rows repeated are repeated in the result. An empty table gives
    no rows; further columns are ignored.
    """
    prints = cut(fingerprints(docs))
    found = roots(prints).withColumnRenamed("fp", "print")
    return prints.join(found, F.col("fp") == F.col("print")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id, all columns.

    Where that id is repeated, or the component has no id, one of its rows stays. Texts that are null or have no word
    have the fingerprint zero; very long ones are read whole. An empty table gives no rows.
    """
    fp, root, lowest, rows = fresh(docs, "fp", "root", "component_id", "rows")
    prints = cut(fingerprints(docs))
    found = cut(roots(prints).withColumnRenamed("fp", "print"))
    marks = prints.join(found, F.col("fp") == F.col("print"))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))

    def by_content(some: DataFrame) -> DataFrame:
        ties = marks.where(stays).groupBy("root").agg(F.count("*").alias("rows"))
        named = cut(found.join(ties, "root").select("print", "root", "component_id", "rows").toDF(fp, root, lowest, rows))
        kept = some.withColumn(fp, print_column(F.col("text"))).join(named, fp).where(F.col("doc_id").eqNullSafe(F.col(lowest)))
        alone, repeated = kept.where(F.col(rows) == 1), kept.where(F.col(rows) > 1).dropDuplicates([root])
        return alone.unionByName(repeated).select(*docs.columns)

    return keep_marked(docs, marks.select("doc_id", stays.alias("stays")), by_content)


def print_column(text: Column) -> Column:
    """The fingerprint as a column, in Arrow batches."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return pandas_udf(run, "long")(text_of(text))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
