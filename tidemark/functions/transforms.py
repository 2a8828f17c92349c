"""Named table transforms: ``DataFrame -> DataFrame`` functions that a spec lists by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import MONEY, field_type, has_column, is_floating, round_cents, strip_text

Transform = Callable[[DataFrame], DataFrame]

_transforms: dict[str, Transform] = {}


def transform(name: str) -> Callable[[Transform], Transform]:
    """Register a transform under a name that is not taken yet."""

    def register(fn: Transform) -> Transform:
        if name in _transforms:
            raise ValueError(f"a transform named {name!r} exists already")
        _transforms[name] = fn
        return fn

    return register


def registered() -> list[str]:
    return sorted(_transforms)


def apply(names: Iterable[str], df: DataFrame) -> DataFrame:
    """Chain the named transforms in order; nothing runs until an action needs the rows."""
    names = list(names)
    unknown = [n for n in names if n not in _transforms]
    if unknown:
        raise KeyError(f"unknown transforms {unknown}; known are {registered()}")
    return reduce(lambda frame, name: frame.transform(_transforms[name]), names, df)


def normalized_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


@transform("normalize_columns")
def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*(normalized_name(c) for c in df.columns))


@transform("trim_strings")
def trim_strings(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: strip_text(F.col(f"`{c}`")) for c in texts})


@transform("add_ingested_at")
def add_ingested_at(df: DataFrame, at: datetime | None = None) -> DataFrame:
    """Stamp every row with one load time, fixed when the plan is built.

    ``current_timestamp()`` would be evaluated anew by each action over the same batch.
    """
    at = at or datetime.now(timezone.utc)
    return df.withColumn("_ingested_at", F.lit(at.isoformat()))


@transform("derive_line_totals")
def derive_line_totals(df: DataFrame) -> DataFrame:
    """Price per unit and the bulk flag; tables without amount and quantity pass unchanged."""
    if not (has_column(df, "amount") and has_column(df, "quantity")):
        return df
    amount, quantity = F.col("amount").cast("double"), F.col("quantity").cast("double")
    bulk = F.col("quantity") >= 5
    if is_floating(field_type(df, "quantity")):
        bulk = bulk & ~F.isnan("quantity")
    return df.withColumns(
        {
            "unit_price_effective": round_cents(F.try_divide(amount, quantity)),
            "is_bulk": F.coalesce(bulk, F.lit(False)),
        }
    )


def mask_pii(df: DataFrame, column: str = "email", pattern: str = "@.*") -> DataFrame:
    """Replace the domain of e-mail addresses, keeping the part before the ``@``.

    Not registered: a project registers it under its own name and columns.
    """
    text = F.col(column)
    masked = F.regexp_replace(text, pattern, "@***")
    if pattern.startswith("@"):
        # Most texts hold no address: a byte search is cheaper than the pattern.
        masked = F.when(text.contains("@"), masked).otherwise(text)
    return df.withColumn(column, masked)


def cast_money(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Store the named amounts as exact ``decimal(18,2)``; names the table lacks are ignored.

    A column keeps the spelling it has in the table. An amount that doesn't fit becomes null; the gate
    counts it before, as the rule ``money``.
    """
    wanted = {c.lower() for c in columns}
    return df.withColumns({c: F.col(f"`{c}`").try_cast(MONEY) for c in df.columns if c.lower() in wanted})


def add_lineage(df: DataFrame, load_id: str) -> DataFrame:
    """Add the load that produced a row and a digest of the row's content.

    The digest covers every column in order, with nulls marked, so equal rows get equal ids in
    every load.
    """
    content = F.to_json(F.array(*(F.col(f"`{c}`").cast("string") for c in df.columns)))
    return df.withColumns({"_load_id": F.lit(load_id), "_row_id": F.sha2(content, 256)})
