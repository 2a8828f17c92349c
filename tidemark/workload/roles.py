"""The star-schema test tables in the roles of the loads: transactions, customers, products, orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import MONEY


# Columns of the test tables. A read with a schema starts no job to look for one.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_sku"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.col("l_shipdate").alias("txn_ts"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "customer")
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        people.join(nations, people.c_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("r_name").alias("region")
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("category"),
        F.col("p_retailprice").cast(MONEY).alias("unit_cost"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as orders of one product each, with the names an orders batch has."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("order_date"),
        F.col("l_suppkey").alias("customer_id"),
        F.col("l_partkey").alias("product"),
        F.col("l_linestatus").alias("category"),
        F.col("l_returnflag").alias("region"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The table with a cursor (``ts``) and a primary key (``event_id``)."""
    return table(spark, folder, "events")
