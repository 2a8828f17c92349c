"""The orders loads: a full one with reports, and an incremental one that keeps its cursor."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import field_type, literal, round_cents
from tidemark.functions.transforms import add_lineage
from tidemark.operators import reports
from tidemark.operators.incremental import max_cursor, since
from tidemark.operators.merge import one_row_per_key, without_keys
from tidemark.operators.orders_gate import OrdersReport, check_orders
from tidemark.operators.quality import QualityError
from tidemark.plans.lake import Lake
from tidemark.session import landed
from tidemark.sinks.destinations import load
from tidemark.sinks.exports import export_csv
from tidemark.sinks.tables import Table
from tidemark.sources.csv import read_csv

ORDERS_SCHEMA = (
    "order_id bigint, order_date date, customer_id string, product string, "
    "category string, region string, quantity bigint, unit_price double"
)
INCREMENTAL_SCHEMA = f"{ORDERS_SCHEMA.replace('order_date date', 'order_date string')}, updated_at string"

TABLE, KEY, CURSOR = "orders", "order_id", "updated_at"

# Fixed value: the mark the first incremental load starts from.
FIRST_WATERMARK = "2000-01-01T00:00:00"


def typed_orders(df: DataFrame) -> DataFrame:
    """Declared types and the revenue of each order. A value that does not fit becomes null, and
    the gate finds it; an exception here would come before the gate.
    """
    quantity, price = F.col("quantity").try_cast("bigint"), F.col("unit_price").try_cast("double")
    return df.withColumns(
        {
            "order_date": F.col("order_date").try_cast("date"),
            "quantity": quantity,
            "unit_price": price,
            "revenue": round_cents(quantity * price),
        }
    )


def load_raw_sales(spark: SparkSession, path: str) -> DataFrame:
    return typed_orders(read_csv(spark, path, ORDERS_SCHEMA))


def all_reports(orders: DataFrame) -> dict[str, DataFrame]:
    return {
        "summary_statistics": reports.summary_statistics(orders),
        "revenue_by_category": reports.revenue_by_category(orders),
        "revenue_by_region": reports.revenue_by_region(orders),
    }


def run_batch(spark: SparkSession, path: str, destination: Mapping, out: str, prefix: str = "") -> list[str]:
    """Read, gate, replace the orders table at the destination, and export the reports."""
    with landed(load_raw_sales(spark, path), TABLE) as orders:
        passed_or_raise(check_orders(orders))
        load(add_lineage(orders, str(uuid.uuid4())), destination, TABLE, "replace", KEY)
        return export_csv(all_reports(orders), out, prefix)


def passed_or_raise(report: OrdersReport) -> None:
    if not report.passed:
        raise QualityError(report.summary())


def incremental_orders(source: DataFrame, watermark) -> DataFrame:
    """Candidate rows at or after the mark, typed, with the date as ISO text."""
    typed = typed_orders(since(source, CURSOR, watermark))
    return typed.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


def not_seen(candidates: DataFrame, table: Table, watermark) -> DataFrame:
    """Candidates without the boundary rows an earlier load has taken already."""
    if not table.exists():
        return candidates
    stored = table.read()
    boundary = stored.where(F.col(CURSOR) == literal(watermark, field_type(stored, CURSOR)))
    return without_keys(candidates.where(F.col(CURSOR) == watermark), boundary, KEY).unionByName(
        candidates.where(F.col(CURSOR) != watermark)
    )


def orders_table(lake: Lake) -> Table:
    return Table(lake.spark, f"{lake.root}/silver/{TABLE}", KEY)


def run_incremental(lake: Lake, path: str) -> int:
    """One incremental load; returns the number of candidate rows read from the source.

    The mark is the cursor the last load reached, kept in the load log. A run that finds nothing
    but boundary rows leaves the table and the log alone.
    """
    table, watermark = orders_table(lake), current_watermark(lake)
    source = read_csv(lake.spark, path, INCREMENTAL_SCHEMA)
    with landed(incremental_orders(source, watermark), TABLE) as candidates:
        count = candidates.count()
        if count == 0:
            return 0
        passed_or_raise(check_orders(candidates.drop(CURSOR, "revenue")))
        fresh = not_seen(candidates, table, watermark)
        rows = fresh.count()
        if rows:
            load_id = str(uuid.uuid4())
            table.merge(add_lineage(one_row_per_key(fresh, KEY, CURSOR), load_id))
            lake.loads().record(load_id, TABLE, "loaded", rows, cursor=max_cursor(candidates, CURSOR))
        return count


def current_watermark(lake: Lake) -> str:
    return lake.loads().last_cursor(TABLE, FIRST_WATERMARK)


def order_snapshot(lake: Lake, order_id: int) -> DataFrame:
    row = orders_table(lake).lookup(order_id=order_id)
    return row.select("order_id", "product", "quantity", "unit_price", "revenue", CURSOR)
