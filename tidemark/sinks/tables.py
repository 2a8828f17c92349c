"""Tables as Parquet, partitioned by a bucket of the primary key and written by Spark's own writer.

``<path>/_bucket=<n>/*.parquet``, and ``<path>/_layout``: one row that says how the rows are grouped.

An upsert reads the buckets its keys fall into and replaces those partitions by dynamic partition
overwrite; Spark stages the new files and moves them at the end, so a job that fails leaves the table as
it was. ``buckets`` hashes the key; ``width`` cuts whole number keys into ranges, which lets a load of
recent keys touch the newest buckets only. A table without a key has one bucket and is replaced as a whole.

The writer moves one partition after the other: a reader may see some of them new and others old, and one
load at a time may write a table. An upsert that is run again gives the same rows.

Rows written are counted by the writing job itself, which observes them after its last shuffle.
"""

from __future__ import annotations

import json
import logging
from collections import Counter
from collections.abc import Iterable
from contextlib import ExitStack
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import literal
from tidemark.functions.transforms import cast_money, normalized_name
from tidemark.operators.incremental import max_cursor
from tidemark.operators.merge import (
    BROADCAST_BYTES,
    BROADCAST_KEYS,
    change_parts,
    conform,
    key_bytes,
    key_list,
    one_row_per_key,
    without_keys,
)
from tidemark.session import landed, one_row
from tidemark.sinks.files import Files

log = logging.getLogger(__name__)

BUCKET = "_bucket"
NO_KEY = "__HIVE_DEFAULT_PARTITION__"

# Buckets when a spec names none: by the bytes of the first load, within these bounds.
BUCKET_BYTES = 4 << 30
LEAST_BUCKETS, MOST_BUCKETS = 8, 8192


class TooManyBuckets(ValueError):
    """The ranges of the key are too narrow for its span; nothing was changed, choose a larger width."""


@dataclass(frozen=True)
class Layout:
    """How rows are grouped: by ``buckets`` hashes or ``width`` ranges of the key, or not at all."""

    key: tuple[str, ...] = ()
    buckets: int | None = None
    width: int | None = None
    schema: T.StructType | None = None

    def column(self) -> Column:
        """The bucket of a row; null for a row without a key, which no upsert can match."""
        if not self.key:
            return F.lit(0).cast("bigint")
        if self.width:
            return F.floor(F.col(self.key[0]) / F.lit(self.width)).cast("bigint")
        keyed = F.lit(True)
        for name in self.key:
            keyed = keyed & F.col(name).isNotNull()
        return F.when(keyed, F.pmod(F.hash(*self.key), F.lit(self.buckets)).cast("bigint"))


class Table:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str | list[str] | None = None,
        buckets: int | None = None,
        width: int | None = None,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        names = tuple(key_list(key)) if key else ()
        if width and len(names) != 1:
            raise ValueError("bucket ranges need exactly one whole-number key column")
        self._wanted = Layout(names, None if width else buckets, width) if names else Layout()
        self._files = Files(spark)

    # -- reading ---------------------------------------------------------------------------------

    def layout(self) -> Layout | None:
        """How the table is stored; none if there is no table."""
        if not self.exists():
            return None
        found = self.spark.read.schema("layout string").parquet(f"{self.path}/_layout").first()[0]
        doc = json.loads(found)
        return Layout(tuple(doc["key"]), doc["buckets"], doc["width"], T.StructType.fromJson(doc["schema"]))

    def _keep(self, layout: Layout) -> None:
        doc = {"key": layout.key, "buckets": layout.buckets, "width": layout.width, "schema": layout.schema.jsonValue()}
        one_row(self.spark, layout=F.lit(json.dumps(doc))).write.mode("overwrite").parquet(f"{self.path}/_layout")

    def exists(self) -> bool:
        return any(n.endswith(".parquet") for n in self._files.names(f"{self.path}/_layout"))

    def _needed(self) -> Layout:
        layout = self.layout()
        if layout is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return layout

    def read(self) -> DataFrame:
        return self._scan(self._needed())

    def _scan(self, layout: Layout, only: set[str] | None = None) -> DataFrame:
        """All rows, or those of some buckets, read with the known schema: no inference."""
        rows = self.spark.read.schema(T.StructType([*layout.schema.fields, T.StructField(BUCKET, T.LongType())]))
        rows = rows.parquet(self.path)
        if only is not None:
            numbers = [int(b) for b in only if b != NO_KEY]
            chosen = F.col(BUCKET).isin(numbers) if numbers else F.lit(False)
            rows = rows.where(chosen | F.col(BUCKET).isNull() if NO_KEY in only else chosen)
        return rows.select(*(F.col(f"`{f.name}`") for f in layout.schema.fields))

    def _buckets(self) -> set[str]:
        found = self._files.names(self.path) if self.exists() else []
        return {n.removeprefix(f"{BUCKET}=") for n in found if n.startswith(f"{BUCKET}=")}

    def lookup(self, **key) -> DataFrame:
        """Rows with one key value: one bucket is opened, whose files are sorted by key."""
        layout = self._needed()
        values = {n: literal(v, layout.schema[n].dataType) for n, v in key.items()}
        only = None
        if layout.key and set(layout.key) <= set(values):
            only = {_name(one_row(self.spark, **values).select(layout.column()).first()[0])}
        rows = self._scan(layout, only)
        for name, value in values.items():
            rows = rows.where(F.col(name) == value)
        return rows

    def row_count(self) -> int:
        """Rows of the table, from the footers of its files; zero if there is no table."""
        return self.read().count() if self.exists() else 0

    def max_cursor(self, cursor: str):
        """The high-water mark held in the table itself: reads that one column.

        The cursor may be named as the source spells it, before column names were normalised.
        """
        layout = self.layout()
        stored = _stored_name(layout.schema, cursor) if layout else None
        return max_cursor(self._scan(layout), stored) if stored else None

    # -- writing ---------------------------------------------------------------------------------

    def _write(
        self, layout: Layout, df: DataFrame | None, settled: DataFrame | None = None, replaced: set[str] | None = None
    ) -> int:
        """Write rows and return their number; with ``replaced`` those buckets hold no others afterwards.

        ``df`` is brought together by bucket: AQE lets small buckets share a task and splits a large
        one over many. ``settled`` holds rows that lie together by bucket already and stays in place.
        """
        given = [d.withColumn(BUCKET, layout.column()) for d in (settled, df) if d is not None]
        if df is not None and layout.key:
            given[-1] = given[-1].hint("rebalance", self._spread(layout), F.col(BUCKET))
        rows, written = reduce(DataFrame.unionByName, given), Observation()
        # Behind the last shuffle, where the rows of a task that runs again count once.
        rows = rows.observe(
            written,
            F.count(F.lit(1)).alias("rows"),
            F.collect_set(F.coalesce(F.col(BUCKET).cast("string"), F.lit(NO_KEY))).alias("buckets"),
        )
        # The write sorts by bucket anyway; with the key as well, file statistics serve lookups.
        writer = rows.sortWithinPartitions(BUCKET, *layout.key).write.partitionBy(BUCKET)
        if replaced is None:
            writer.mode("append").parquet(self.path)
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
            for bucket in replaced - set(written.get["buckets"]):
                self._files.remove(f"{self.path}/{BUCKET}={bucket}")
        return written.get["rows"]

    def _spread(self, layout: Layout) -> int:
        """Shuffle partitions that bring rows together by bucket.

        Twice the buckets, so that few share a partition: when AQE splits a large partition, each
        piece writes a file for every bucket in it. Small partitions are merged again.
        """
        usual = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return max(usual, 2 * (layout.buckets or LEAST_BUCKETS))

    def _new_layout(self, df: DataFrame) -> Layout:
        """Where the number of buckets isn't given it follows from the bytes of the rows."""
        layout = replace(self._wanted, schema=T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))
        if layout.width:
            counts_by_bucket(df, layout)
        elif layout.key and not layout.buckets:
            layout = replace(layout, buckets=_bucket_count(df.agg(row_bytes(df)).first()[0] or 0))
        return layout

    def overwrite(self, df: DataFrame) -> int:
        """Replace all rows; the schema may change. The rows may come from this very table."""
        layout = self._new_layout(df)
        rows = self._write(layout, df, replaced=self._buckets())
        self._keep(layout)
        return rows

    def append(self, df: DataFrame) -> int:
        layout = self.layout()
        return self._write(layout, conform(df, layout.schema)) if layout else self.overwrite(df)

    def append_and_delete(self, batch: DataFrame, dead: DataFrame | None, key: str | list[str]) -> None:
        """Delete the keys of ``dead``, then add the other rows without looking at their keys."""
        if dead is not None:
            self.delete(dead, key)
            batch = without_keys(batch, dead, key)
        self.append(batch)

    def merge(self, batch: DataFrame, dead: DataFrame | None = None, key: str | list[str] | None = None) -> None:
        """Upsert a batch with unique keys and delete the keys of ``dead``, in one write.

        Only the buckets these keys fall into are read and written. The batch is read more than
        once and must be the same each time, see ``landed``. Rows without a key are added.
        """
        layout = self.layout()
        names = key_list(key or list((layout or self._wanted).key))
        if not names:
            raise ValueError("an upsert needs a primary key")
        if layout is None:
            self.overwrite(batch if dead is None else without_keys(batch, dead, names))
            return
        batch = conform(batch, layout.schema)
        dead = batch.select(*names).limit(0) if dead is None else _fit_keys(dead, names, layout.schema)
        self._replace(layout, names, batch, dead)

    def delete(self, keys: DataFrame, key: str | list[str] | None = None) -> None:
        """Delete the rows with these keys; nothing happens if there is no table."""
        layout = self.layout()
        if layout is None:
            return
        names = key_list(key or list(layout.key))
        self._replace(layout, names, _no_rows(self.spark, layout.schema), _fit_keys(keys, names, layout.schema))

    def _replace(self, layout: Layout, names: list[str], batch: DataFrame, dead: DataFrame) -> None:
        keys, added = batch.select(*names).unionByName(dead), None
        if [k.lower() for k in layout.key] == [n.lower() for n in names]:
            counts = counts_by_bucket(keys, layout, key_bytes(keys))
            key_rows, size = (sum(c[i] for c in counts.values()) for i in (0, 1))
            touched = set(counts) - {NO_KEY}
            if NO_KEY in counts:
                keyed = layout.column().isNotNull()
                batch, added = batch.where(keyed), batch.where(~keyed)
        else:
            key_rows, size = keys.agg(F.count(F.lit(1)), F.coalesce(key_bytes(keys), F.lit(0))).first()
            touched = self._buckets()
        few = key_rows <= BROADCAST_KEYS and size <= BROADCAST_BYTES
        stay, fresh = change_parts(self._scan(layout, touched), batch, dead, names, key_rows, few)
        # The rows that stay are where their bucket is: they aren't shuffled, or only a few of them are.
        rows = self._write(layout, fresh, settled=stay, replaced=touched) if touched else 0
        if added is not None:
            rows += self._write(layout, added)
        log.info("%s: %d keys, %d buckets with %d rows written", self.path, key_rows, len(touched), rows)

    def compact(self, most: int = 16) -> int:
        """Bring the buckets of more than ``most`` files, as many appends leave them, together; how many these were."""
        layout = self._needed()
        folders = Counter(f.rsplit("/", 2)[-2].removeprefix(f"{BUCKET}=") for f in self._scan(layout).inputFiles())
        many = {bucket for bucket, files in folders.items() if files > most}
        if many:
            self._write(layout, self._scan(layout, many), replaced=many)
        return len(many)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of all rows, before they are compressed: what texts hold, and a word for every other column."""
    texts = (T.StringType, T.BinaryType)
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if isinstance(f.dataType, texts) else F.lit(8)
        for f in df.schema.fields
    ]
    return F.sum(sum(sizes[1:], sizes[0]).cast("bigint"))


def counts_by_bucket(df: DataFrame, layout: Layout, measure: Column | None = None) -> dict[str, tuple]:
    """Rows, and a measure, per bucket. Hashes are bounded by their number; ranges follow from the keys
    and are bounded here.
    """
    counts = df.groupBy(layout.column().alias(BUCKET)).agg(F.count(F.lit(1)), measure if measure is not None else F.lit(0))
    rows = counts.limit(MOST_BUCKETS + 2).collect()
    if len(rows) > MOST_BUCKETS + 1:
        raise TooManyBuckets(f"rows fall into more than {MOST_BUCKETS} buckets")
    return {_name(r[0]): (r[1], r[2]) for r in rows}


def _bucket_count(size: int) -> int:
    """Buckets of a few GB."""
    return min(max(-(-size // BUCKET_BYTES), LEAST_BUCKETS), MOST_BUCKETS)


def _stored_name(schema: T.StructType, column: str) -> str | None:
    """The table's spelling of a column: as it is, without regard to case, or normalised."""
    names = {f.name.lower(): f.name for f in schema.fields}
    return names.get(column.lower()) or names.get(normalized_name(column))


def _name(bucket: int | None) -> str:
    return NO_KEY if bucket is None else str(bucket)


def _no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame the optimizer knows to be empty."""
    return spark.range(0).where(F.lit(False)).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def _fit_keys(df: DataFrame, names: list[str], schema: T.StructType) -> DataFrame:
    """Keys in the table's own types: a hash differs between an int and a bigint."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    return df.select(*(F.col(n).cast(types[n.lower()]).alias(n) for n in names))


MODES = ("merge", "overwrite", "append")


def write(
    table: Table,
    df: DataFrame,
    mode: str,
    primary_key: str | list[str] | None = None,
    money_columns: Iterable[str] = (),
    cursor: str | None = None,
) -> int:
    """Store a frame in one of three ways and return its number of rows.

    A merge whose batch repeats a key keeps the row with the highest cursor.
    """
    df = cast_money(df, money_columns)
    if mode == "overwrite":
        return table.overwrite(df)
    if mode == "append":
        return table.append(df)
    if mode == "merge":
        if not primary_key:
            raise ValueError("merge needs a primary key")
        with ExitStack() as stack:
            batch = stack.enter_context(landed(df))
            newest = one_row_per_key(batch, primary_key, cursor)
            if newest is not batch:
                newest = stack.enter_context(landed(newest))
            table.merge(newest, key=primary_key)
            return batch.count()
    raise ValueError(f"unknown write mode {mode!r}; use one of {', '.join(MODES)}")
