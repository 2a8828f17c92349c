"""Summary reports over orders and the sales mart.

Amounts are summed exactly and rounded once, after the sum, so a total does not depend on how the rows
were partitioned. Totals are wider than the amounts, as ``decimal(18,2)`` overflows on large tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import MONEY, field_type, is_floating

TOTAL = "decimal(28,2)"

# Floating amounts below this are added as whole numbers, the others as decimals. From the second on, as
# infinities do, they count as missing.
LARGE, TOO_LARGE = 1e6, 1e19
FRACTION = 100_000_000


def amount(df: DataFrame, column: str) -> Column:
    """The amount; NaN and what is no number of money counts as missing."""
    value = F.col(column)
    if is_floating(field_type(df, column)):
        value = value.cast("double")
        return F.when(~F.isnan(value) & (F.abs(value) < TOO_LARGE), value)
    return value


def exact_sum(df: DataFrame, column: str) -> Column:
    """Sum of amounts to eight decimals, not rounded further. Usual floating amounts are added as whole
    numbers, in two parts that cannot overflow: that takes a fraction of the time of decimals.
    """
    value = amount(df, column)
    if not is_floating(field_type(df, column)):
        return F.sum(value)
    usual = F.when(F.abs(value) < LARGE, value)
    below = F.floor(usual)
    parts = F.rint((usual - below) * FRACTION).cast("bigint")
    large = F.when(F.abs(value) >= LARGE, value.cast("decimal(28,8)"))
    whole, fraction, rest = (F.coalesce(F.sum(c), F.lit(0)) for c in (below, parts, large))
    added = whole.cast("decimal(28,0)") + fraction.cast("decimal(19,0)") * F.lit("0.00000001").cast("decimal(8,8)")
    return F.when(F.count(value) > 0, added.cast("decimal(38,8)") + rest.cast("decimal(38,8)"))


def total(df: DataFrame, column: str) -> Column:
    return F.round(exact_sum(df, column), 2).cast(TOTAL)


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Frames of one row each as one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))


def summary_statistics(orders: DataFrame) -> DataFrame:
    """One row: orders, units, revenue, average order value, and distinct customers.

    Customers are counted apart: only their ids are shuffled then, not all sums once per customer.
    """
    sums = orders.agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        total(orders, "revenue").alias("total_revenue"),
        F.round(F.try_divide(exact_sum(orders, "revenue"), F.count(amount(orders, "revenue"))), 2)
        .cast(MONEY)
        .alias("avg_order_value"),
    )
    return side_by_side(sums, orders.agg(F.countDistinct("customer_id").alias("unique_customers")))


def revenue_by(orders: DataFrame, group: str) -> DataFrame:
    """Orders and revenue per group, highest revenue first."""
    revenue = total(orders, "revenue").alias("revenue")
    grouped = orders.groupBy(group).agg(F.count(F.lit(1)).alias("orders"), revenue)
    return grouped.orderBy(F.desc("revenue"), group)


def revenue_by_category(orders: DataFrame) -> DataFrame:
    return revenue_by(orders, "category")


def revenue_by_region(orders: DataFrame) -> DataFrame:
    return revenue_by(orders, "region")


def bi_report(mart: DataFrame) -> DataFrame:
    """Orders, units, revenue and margin per region and category, highest revenue first."""
    grouped = mart.groupBy("region", "category").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("quantity").alias("units"),
        total(mart, "revenue").alias("revenue"),
        total(mart, "gross_margin").alias("gross_margin"),
    )
    return grouped.orderBy(F.desc("revenue"), "region", "category")


def top_rows(df: DataFrame, measure: str, k: int, tie_break: str) -> DataFrame:
    """The k rows with the highest measure; every task keeps k rows, none is sorted in full."""
    return df.orderBy(F.desc(measure), tie_break).limit(k)


def describe_columns(df: DataFrame) -> DataFrame:
    """Name and type of every column in order, taken from the schema alone."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")
