"""The gate of the orders load: six named checks over a whole batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import field_type, has_column, is_missing, is_positive
from tidemark.operators.reports import side_by_side

# Columns an orders batch needs, and the names of the checks in report order.
REQUIRED = ("order_id", "order_date", "customer_id", "product", "category", "region", "quantity", "unit_price")
CHECKS = (
    "all_required_columns_present",
    "no_nulls_in_required_fields",
    "order_id_is_unique",
    "quantity_positive",
    "unit_price_positive",
    "order_date_parses",
)

# Error texts of the checks, in report order.
MISSING = "Missing columns: {}"
NULLS = "Null values found in: {}"
DUPLICATES = "{} duplicate order_id value(s)"
QUANTITY = "Non-positive quantity detected"
PRICE = "Non-positive unit_price detected"
DATES = "Unparseable order_date value(s)"


@dataclass(frozen=True)
class OrdersReport:
    total_rows: int
    checks: dict[str, bool]
    errors: list[str]

    @property
    def passed(self) -> bool:
        return all(self.checks.values())

    def summary(self) -> str:
        failed = [name for name, ok in self.checks.items() if not ok]
        verdict = f"failed {', '.join(failed)}: {'; '.join(self.errors)}" if failed else "passed all checks"
        return f"{self.total_rows} orders {verdict}"


def missing_columns(df: DataFrame) -> list[str]:
    return sorted(c for c in REQUIRED if not has_column(df, c))


def order_counts(df: DataFrame) -> DataFrame:
    """Violations of every check as one row.

    A repeated id counts once per row beyond its first. Nulls are one id among the others. Ids are
    counted apart from the other checks: only they are shuffled then, not all counts once per id.
    """
    dates = F.col("order_date")
    if isinstance(field_type(df, "order_date"), T.StringType):
        dates = F.try_to_timestamp(dates)
    nulls = {c: F.count_if(is_missing(F.col(c), field_type(df, c))) for c in REQUIRED}
    checks = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *(n.alias(f"null_{c}") for c, n in nulls.items()),
        F.count_if(~is_positive(F.col("quantity"), field_type(df, "quantity"))).alias("bad_quantity"),
        F.count_if(~is_positive(F.col("unit_price"), field_type(df, "unit_price"))).alias("bad_price"),
        F.count_if(dates.isNull()).alias("bad_date"),
    )
    ids = df.agg(F.countDistinct("order_id").alias("ids"))
    repeated = F.col("total_rows") - F.col("ids") - F.least("null_order_id", F.lit(1))
    return side_by_side(checks, ids).withColumn("repeated_ids", repeated)


def orders_gate(df: DataFrame) -> DataFrame:
    """The checks as one row of booleans. With a column missing, the other checks stay null."""
    if missing_columns(df):
        empty = [F.lit(None).cast("boolean").alias(c) for c in CHECKS[1:]]
        return df.agg(F.count(F.lit(1)).alias("total_rows"), F.lit(False).alias(CHECKS[0])).select("*", *empty)
    nulls = sum((F.col(f"null_{c}") for c in REQUIRED), F.lit(0))
    counts = {
        CHECKS[1]: nulls,
        CHECKS[2]: F.col("repeated_ids"),
        CHECKS[3]: F.col("bad_quantity"),
        CHECKS[4]: F.col("bad_price"),
        CHECKS[5]: F.col("bad_date"),
    }
    return order_counts(df).select(
        "total_rows", F.lit(True).alias(CHECKS[0]), *((n == 0).alias(name) for name, n in counts.items())
    )


def check_orders(df: DataFrame) -> OrdersReport:
    """Run the checks: one job, one row to the driver."""
    missing = missing_columns(df)
    if missing:
        return OrdersReport(df.count(), {CHECKS[0]: False}, [MISSING.format(missing)])
    row = order_counts(df).first()
    with_nulls = [c for c in REQUIRED if row[f"null_{c}"]]
    found = {
        CHECKS[1]: with_nulls and NULLS.format(with_nulls),
        CHECKS[2]: row["repeated_ids"] and DUPLICATES.format(row["repeated_ids"]),
        CHECKS[3]: row["bad_quantity"] and QUANTITY,
        CHECKS[4]: row["bad_price"] and PRICE,
        CHECKS[5]: row["bad_date"] and DATES,
    }
    checks = {CHECKS[0]: True, **{name: not problem for name, problem in found.items()}}
    return OrdersReport(row["total_rows"], checks, [p for p in found.values() if p])
