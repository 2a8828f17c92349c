"""High-water marks: find them, move them back by a lag, and read from them on."""

from __future__ import annotations

import numbers
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import field_type, has_column, is_floating, literal

TEXT_TIMESTAMP = "%Y-%m-%dT%H:%M:%S"


def highest_cursor(df: DataFrame, cursor: str) -> Column:
    """The highest cursor as an aggregate. NaN, which Spark ranks highest, is left out."""
    column = F.col(cursor)
    if is_floating(field_type(df, cursor)):
        column = F.when(~F.isnan(column), column)
    return F.max(column)


def max_cursor_frame(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(highest_cursor(df, cursor).alias("max_cursor"))


def max_cursor(df: DataFrame, cursor: str):
    """The high-water mark as one value, null for an empty table."""
    return max_cursor_frame(df, cursor).first()["max_cursor"]


def apply_lag(watermark, seconds: int):
    """The mark moved back, so that rows which arrived late are read again.

    Text holds an ISO timestamp and stays text; text that is none is returned unchanged.
    """
    if watermark is None or seconds <= 0 or isinstance(watermark, bool):
        return watermark
    if isinstance(watermark, (numbers.Number, Decimal)):
        return watermark - seconds
    back = timedelta(seconds=seconds)
    if isinstance(watermark, datetime):
        return watermark - back
    if isinstance(watermark, date):
        # A date has no time of day: go back whole days, and never less than asked.
        return watermark - timedelta(days=-(-seconds // 86400))
    try:
        parsed = datetime.fromisoformat(str(watermark).strip())
    except ValueError:
        return watermark
    return (parsed - back).strftime(TEXT_TIMESTAMP)


def lagged(column: Column, dtype: T.DataType, seconds: int) -> Column:
    """The same move as a column expression."""
    if seconds <= 0:
        return column
    if isinstance(dtype, T.NumericType):
        return column - seconds
    back = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))
    if isinstance(dtype, T.StringType):
        moved = F.date_format(column.try_cast("timestamp_ntz") - back, "yyyy-MM-dd'T'HH:mm:ss")
        return F.coalesce(moved, column)
    return column - back


def since(df: DataFrame, cursor: str | None, watermark) -> DataFrame:
    """Rows at or after the mark, compared in the column's own type.

    The boundary row is read again on purpose: an upsert absorbs it, and a row with the same
    cursor that came later is not lost. The filter reaches a database, Parquet or CSV scan.
    """
    if not cursor or watermark is None or not has_column(df, cursor):
        return df
    return df.where(F.col(cursor) >= literal(watermark, field_type(df, cursor)))


def late_rows(df: DataFrame, cursor: str, watermark, seconds: int) -> DataFrame:
    """Rows that only the lag window brings in: behind the mark, but not behind it by more."""
    dtype = field_type(df, cursor)
    behind = F.col(cursor) < literal(watermark, dtype)
    return since(df, cursor, apply_lag(watermark, seconds)).where(behind)
