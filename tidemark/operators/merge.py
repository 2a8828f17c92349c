"""Upsert and delete by key, as joins against the keys of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import field_type, has_column, is_flagged

Key = str | list[str] | tuple[str, ...]

# Key sets up to this many rows, and bytes, are broadcast; counted before, never assumed.
BROADCAST_KEYS, BROADCAST_BYTES = 2_000_000, 64 << 20

# Bits of a bitmap of keys, as powers of two: from 128 kB to 64 MB.
LEAST_BITS, MOST_BITS = 20, 29


class DuplicateKeys(ValueError):
    """A batch holds a key twice and nothing tells which row is the newer one."""


def key_list(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_bytes(keys: DataFrame) -> Column:
    """Bytes of all keys: what their texts hold, and a word for every other column."""
    texts = (T.StringType, T.BinaryType)
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if isinstance(f.dataType, texts) else F.lit(8)
        for f in keys.schema.fields
    ]
    return F.sum(sum(sizes[1:], sizes[0]).cast("bigint"))


def without_keys(df: DataFrame, keys: DataFrame, key: Key, key_rows: int | None = None, few: bool | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``; a null key matches nothing and stays.

    Only the key columns of the right side take part. If its row count is known and small it is
    broadcast and ``df`` is not shuffled; if it is known and large, a bitmap of the keys keeps most of
    ``df`` out of the shuffle; otherwise Spark decides by its own size estimates, and AQE splits a
    key that holds many rows of ``df``. ``few`` says that the keys were found small, in bytes too.
    """
    names = key_list(key)
    keys = keys.select(*names)
    if few is None and key_rows is not None:
        few = key_rows <= BROADCAST_KEYS
    if few:
        keys = F.broadcast(keys)
    elif few is not None:
        return without_many_keys(df, keys, key, key_rows)
    return df.join(keys, names, "left_anti")


def without_many_keys(df: DataFrame, keys: DataFrame, key: Key, key_rows: int) -> DataFrame:
    """The same for a key set too large to broadcast: only rows that a bitmap of the keys' hashes can't
    clear are shuffled to meet the keys.
    """
    clear, suspect = split_by_bitmap(df, keys, key, bitmap_bits(key_rows))
    names = key_list(key)
    return clear.unionByName(suspect.join(keys.select(*names), names, "left_anti"))


def bitmap_bits(key_rows: int) -> int:
    """Width of the hash: 32 bits of the bitmap a key, which lets one row in 32 pass for nothing, up to 64 MB."""
    return min(max((32 * max(key_rows, 1) - 1).bit_length(), LEAST_BITS), MOST_BITS)


def split_by_bitmap(df: DataFrame, keys: DataFrame, key: Key, bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose key is surely none of ``keys`` (or null), and the rows that have to be looked up.

    The bitmap is built by Spark's own aggregate, 4 kB for every 32,768 hashes, and broadcast: its size
    follows from ``bits``, whatever the number of keys.
    """
    names = key_list(key)

    def hashed() -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(1 << bits))

    built = keys.dropna(subset=names).select(hashed().alias("_hash"))
    built = built.groupBy(F.bitmap_bucket_number("_hash").alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_hash")).alias("_bitmap")
    )
    keyed = F.lit(True)
    for name in names:
        keyed = keyed & F.col(name).isNotNull()
    own = df.withColumn("_own", F.when(keyed, hashed()))
    marked = own.join(F.broadcast(built), F.bitmap_bucket_number("_own") == F.col("_part"), "left")
    position = F.bitmap_bit_position("_own")
    byte = F.substring("_bitmap", (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(value, (position % 8).cast("int")) == 1, F.lit(False))
    return tuple(marked.where(rule).select(*(f"`{c}`" for c in df.columns)) for rule in (~hit, hit))


def conform(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring a batch to the columns, order and types of the table it goes into."""
    known = {f.name.lower() for f in schema.fields}
    extra = [c for c in batch.columns if c.lower() not in known]
    missing = [f.name for f in schema.fields if not has_column(batch, f.name)]
    if extra or missing:
        raise ValueError(f"batch does not fit the table: unknown {extra}, missing {missing}")
    return batch.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields))


def upsert(target: DataFrame, batch: DataFrame, key: Key, key_rows: int | None = None) -> DataFrame:
    """Rows of the batch replace rows with the same key; other rows of both sides are kept."""
    return without_keys(target, batch, key, key_rows).unionByName(conform(batch, target.schema))


def change_parts(
    target: DataFrame,
    batch: DataFrame,
    dead: DataFrame,
    key: Key,
    key_rows: int | None = None,
    few: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Upsert ``batch`` and delete the keys of ``dead``: rows that stay, and rows that come in.

    A key that is both live and deleted in one load ends up deleted.
    """
    names = key_list(key)
    gone = batch.select(*names).unionByName(dead.select(*names))
    kept = without_keys(target, gone, key, key_rows, few)
    return kept, conform(without_keys(batch, dead, key, key_rows, few), target.schema)


def apply_changes(
    target: DataFrame, batch: DataFrame, dead: DataFrame, key: Key, key_rows: int | None = None
) -> DataFrame:
    """Both parts as one result."""
    kept, fresh = change_parts(target, batch, dead, key, key_rows)
    return kept.unionByName(fresh)


def latest_by_key(batch: DataFrame, key: Key, cursor: str) -> DataFrame:
    """One row per key, the one with the highest cursor; equal cursors are decided by row content.

    An aggregation rather than a window: every task first reduces its share to one row per key,
    so a key with very many versions does not end up in one place. Null keys never match anything
    and pass unchanged.
    """
    names = key_list(key)
    keyed = F.lit(True)
    for name in names:
        keyed = keyed & F.col(name).isNotNull()
    versions = F.struct(F.col(cursor), F.struct(*(F.col(f"`{c}`") for c in batch.columns)).alias("row"))
    newest = (
        batch.where(keyed)
        .groupBy(*(F.col(n).alias(f"_k{i}") for i, n in enumerate(names)))
        .agg(F.max(versions).alias("_newest"))
        .select("_newest.row.*")
    )
    return newest.unionByName(batch.where(~keyed))


def repeated_key_count(batch: DataFrame, key: Key) -> int:
    """How many non-null keys occur more than once."""
    names = key_list(key)
    counts = batch.select(*names).dropna(subset=names).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where("_n > 1").count()


def one_row_per_key(batch: DataFrame, key: Key, cursor: str | None) -> DataFrame:
    """A batch an upsert can take: checked over the keys alone, reduced only when needed."""
    repeats = repeated_key_count(batch, key)
    if not repeats:
        return batch
    if cursor is None:
        raise DuplicateKeys(f"{repeats} keys of {key_list(key)} repeat and there is no cursor to order them")
    return latest_by_key(batch, key, cursor)


def soft_delete_flag(batch: DataFrame, column: str | None) -> Column:
    """True for rows the source marks as deleted; without such a column no row is."""
    if not column or not has_column(batch, column):
        return F.lit(False)
    return is_flagged(F.col(column), field_type(batch, column))
