"""Column expressions shared by the operators. All of them stay inside generated code."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def field_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a column, found without regard to case."""
    for field in df.schema.fields:
        if field.name.lower() == name.lower():
            return field.dataType
    raise KeyError(name)


def has_column(df: DataFrame, name: str) -> bool:
    return name.lower() in {c.lower() for c in df.columns}


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def strip_text(column: Column) -> Column:
    """Remove all surrounding whitespace; a plain trim removes blanks only."""
    return F.btrim(column, F.lit(WHITESPACE))


def round_cents(column: Column) -> Column:
    """Two decimals, ties to the even neighbour, as binary floating point is usually rounded."""
    return F.rint(column * 100) / 100


def is_missing(column: Column, dtype: T.DataType) -> Column:
    """Null, or NaN in a floating column."""
    if is_floating(dtype):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def is_positive(column: Column, dtype: T.DataType) -> Column:
    """Strictly above zero, never null. Spark orders NaN above every number, hence the guard."""
    above = column > 0
    if is_floating(dtype):
        above = above & ~F.isnan(column)
    return F.coalesce(above, F.lit(False))


def is_flagged(column: Column, dtype: T.DataType) -> Column:
    """Truth of a soft-delete flag. A null or unreadable flag means the row is live."""
    if isinstance(dtype, T.StringType):
        truth = strip_text(column).try_cast("boolean")
    elif isinstance(dtype, T.BooleanType):
        truth = column
    elif is_floating(dtype):
        truth = (column != 0) & ~F.isnan(column)
    else:
        truth = column != 0
    return F.coalesce(truth, F.lit(False))


def literal(value, dtype: T.DataType) -> Column:
    """A literal of exactly the column's type, so that the comparison reaches the scan.

    A Python datetime would become an instant; a column without time zone would then be cast
    row by row and the filter would not be pushed down.
    """
    if isinstance(value, (datetime, date)) and isinstance(dtype, (T.TimestampNTZType, T.StringType)):
        return F.lit(value.isoformat()).cast(dtype)
    if isinstance(value, Decimal) and isinstance(dtype, T.DecimalType):
        return F.lit(value)
    return F.lit(value).cast(dtype)


def key_digest(df: DataFrame, name: str) -> Column:
    """A short, null-preserving stand-in for a grouping key.

    Text of any length becomes 32 bytes (SHA-256), so that grouping by it does not shuffle the
    text. A NaN becomes null: both count as the same missing value.
    """
    dtype = field_type(df, name)
    column = F.col(name)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.unhex(F.sha2(column, 256))
    if is_floating(dtype):
        return F.when(~F.isnan(column), column)
    return column
