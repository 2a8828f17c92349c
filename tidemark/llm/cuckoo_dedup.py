"""Exact duplicates, found with cuckoo-filter indexes of live digests.

Texts are equal when they are identical after deleting ASCII white space. Every task of the scan folds
its rows into an index of its own, so that a group of copies of any size leaves it as one entry; the
entries are shuffled by digest and folded once more. What is shuffled is a digest and a few numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, arrow_schema, cut, fresh, keep_marked, table, text_of, to_batch

SLOTS = 4
#: Moves of one insertion before the filter counts as full.
MOST_MOVES = 200
#: Digests of one index. A task of the scan hands on what it has by then; of the second fold there are enough tasks.
MOST_ENTRIES = 500_000
ENTRY = "digest string, n long, keep_id long, group_size long, ties long"


class CuckooIndex:
    """Values of live digests behind a cuckoo filter.

    A digest's 16-bit fingerprint lies in one of two buckets of four slots. Where neither holds it the
    digest is absent. A hit is verified against the digests stored under the first bucket. An insertion
    that finds no slot doubles the filter, which is built anew from the stored digests.
    """

    def __init__(self, buckets: int = 256):
        if buckets < 1 or buckets & (buckets - 1):
            raise ValueError("buckets must be a power of two")
        self._clear(buckets)
        self.size = 0

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.slots = [[] for _ in range(buckets)]
        self.content: list[list[list]] = [[] for _ in range(buckets)]

    def _place(self, digest: str) -> tuple[int, int, int]:
        mark = int(digest[16:20], 16) or 1
        home = int(digest[:16], 16) & self.mask
        return mark, home, self._other(home, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & self.mask)

    def find(self, digest: str) -> list | None:
        """The entry [digest, value], or None."""
        mark, home, other = self._place(digest)
        if mark not in self.slots[home] and mark not in self.slots[other]:
            return None
        return next((entry for entry in self.content[home] if entry[0] == digest), None)

    def insert(self, digest: str, value) -> None:
        """Add a digest that isn't there."""
        self.content[self._place(digest)[1]].append([digest, value])
        self.size += 1
        if not self._mark(digest):
            self._grow()

    def delete(self, digest: str) -> bool:
        mark, home, other = self._place(digest)
        for at, entry in enumerate(self.content[home]):
            if entry[0] == digest:
                del self.content[home][at]
                (self.slots[home] if mark in self.slots[home] else self.slots[other]).remove(mark)
                self.size -= 1
                return True
        return False

    def _mark(self, digest: str) -> bool:
        mark, home, other = self._place(digest)
        bucket = home if len(self.slots[home]) <= len(self.slots[other]) else other
        for move in range(MOST_MOVES):
            slots = self.slots[bucket]
            if len(slots) < SLOTS:
                slots.append(mark)
                return True
            at = move % SLOTS
            mark, slots[at] = slots[at], mark
            bucket = self._other(bucket, mark)
        return False

    def _grow(self) -> None:
        kept = [entry for bucket in self.content for entry in bucket]
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._clear(buckets)
            for entry in kept:
                self.content[self._place(entry[0])[1]].append(entry)
            if all(self._mark(entry[0]) for entry in kept):
                return

    def __iter__(self) -> Iterator[list]:
        return (entry for bucket in self.content for entry in bucket)


def rank(n: int, doc_id: int | None) -> tuple:
    """The smallest stays: most code points, then smallest id; rows without an id come last."""
    return (-n, doc_id is None, doc_id or 0)


def fold(index: CuckooIndex, digest: str, n: int, doc_id: int | None, count: int, ties: int) -> None:
    entry = index.find(digest)
    if entry is None:
        index.insert(digest, (n, doc_id, count, ties))
        return
    best_n, best_id, seen, best_ties = entry[1]
    new, old = rank(n, doc_id), rank(best_n, best_id)
    if new < old:  # the live row is replaced
        index.delete(digest)
        index.insert(digest, (n, doc_id, seen + count, ties))
    else:
        entry[1] = (best_n, best_id, seen + count, best_ties + ties * (new == old))


def fold_batches(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """One entry per digest; with ``most`` a digest may leave more than once, as the index starts anew when it holds so many."""
    index, schema = CuckooIndex(), arrow_schema(ENTRY)
    for batch in batches:
        for row in zip(*(batch.column(f.name).to_pylist() for f in schema)):
            fold(index, *row)
        if most and index.size >= most:
            yield from entries(index, schema)
            index = CuckooIndex()
    yield from entries(index, schema)


def entries(index: CuckooIndex, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for digest, value in index:
        rows.append((digest, *value))
        if len(rows) == 50_000:
            yield to_batch(dict(zip(schema.names, zip(*rows))), schema)
            rows = []
    if rows:
        yield to_batch(dict(zip(schema.names, zip(*rows))), schema)


def normal_digest(text: str | Column) -> Column:
    """SHA-256, in lower-case hex, of a text without its ASCII white space."""
    return F.sha2(F.regexp_replace(text_of(text), SPACE + "+", ""), 256)


def duplicate_groups(rows: DataFrame) -> DataFrame:
    """One row per text: digest, n and keep_id of the row that stays, group_size, ties.

    ``rows`` has digest, n (code points of the original text) and doc_id. ``ties`` counts the rows that
    are equal in all three to the one that stays.
    """
    start = rows.select(
        "digest",
        F.col("n").cast("long").alias("n"),
        F.col("doc_id").cast("long").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(1).cast("long").alias("ties"),
    )
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = rows.count() // MOST_ENTRIES + 1
    parts = start.mapInArrow(partial(fold_batches, most=MOST_ENTRIES), ENTRY)
    parts = parts.repartition(tasks, "digest") if tasks > usual else parts.repartition("digest")
    return parts.mapInArrow(fold_batches, ENTRY)


def exact_groups(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the verdict on it.

    A null text counts as empty; all empty texts are one group. Rows without an id stay only if no copy
    has one. Rows repeated with the same id and length share one verdict. An empty table gives no rows;
    further columns are ignored.
    """
    rows = cut(docs.select("doc_id", normal_digest("text").alias("digest"), F.length(text_of("text")).cast("long").alias("n")))
    groups = duplicate_groups(rows).withColumnRenamed("n", "keep_n")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n"))
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", stays.alias("kept"), F.col("digest").alias("text_sha256")
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without exact copies: one row of each group stays, with all its columns.

    Null and empty texts are one group; very long texts are compared whole. Of rows repeated with the same id and length
    one stays. An empty table gives no rows; further columns are kept, whatever their names.
    """
    n = F.length(text_of("text")).cast("long")
    rows = cut(docs.select("doc_id", normal_digest("text").alias("digest"), n.alias("n")))
    groups = cut(duplicate_groups(rows).withColumnRenamed("n", "keep_n"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n"))
    marks = rows.join(groups, "digest").select("doc_id", stays.alias("stays"))
    digest, best, best_id, size, ties = fresh(docs, "digest", "keep_n", "keep_id", "group_size", "ties")

    def by_content(some: DataFrame) -> DataFrame:
        best_row = F.col("doc_id").eqNullSafe(F.col(best_id)) & (n == F.col(best))
        named = groups.select("digest", "keep_n", "keep_id", "group_size", "ties").toDF(digest, best, best_id, size, ties)
        kept = some.withColumn(digest, normal_digest("text")).join(named, digest).where(best_row)
        # Only rows repeated with the same id need a further step.
        alone, repeated = kept.where(F.col(ties) == 1), kept.where(F.col(ties) > 1).dropDuplicates([digest])
        return alone.unionByName(repeated).select(*docs.columns)

    return keep_marked(docs, marks, by_content)


def op6_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h
  FROM documents
), g AS (
  SELECT h, count(*) AS group_size, max(n) AS n FROM d GROUP BY h
), k AS (
  SELECT d.h, min(doc_id) AS keep_id FROM d JOIN g ON d.h = g.h AND d.n = g.n GROUP BY d.h
)
SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, d.h AS text_sha256
FROM d JOIN g ON d.h = g.h JOIN k ON d.h = k.h
"""
