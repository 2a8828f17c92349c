"""Report totals at the edges: many rows, large amounts, negative cents, no rows."""

from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators import reports


def test_totals_are_exact_and_do_not_depend_on_partitions(spark):
    amounts = [0.1, 0.2, -0.3, 1234567.89, -99.99, 45_000_000_000_000.01, 10_000_000_000.1]
    df = spark.createDataFrame([("a", x) for x in amounts] * 300, "region string, revenue double")
    want = sum(Decimal(str(x)) for x in amounts) * 300
    for parts in (1, 7):
        row = reports.revenue_by_region(df.repartition(parts)).first()
        assert (row["orders"], row["revenue"]) == (2100, want)
    exact = df.withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
    assert reports.revenue_by_region(exact).first()["revenue"] == want


def test_summary_of_nothing(spark):
    df = spark.createDataFrame([], "customer_id int, quantity bigint, revenue double")
    row = reports.summary_statistics(df).first()
    assert tuple(row) == (0, None, None, None, 0)


def test_order_and_ties(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 5.0)], "category string, revenue double")
    assert [r["category"] for r in reports.revenue_by_category(df).collect()] == ["c", "a", "b"]
    assert [r["category"] for r in reports.top_rows(df, "revenue", 2, "category").collect()] == ["c", "a"]
    plan = reports.top_rows(df, "revenue", 2, "category")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_sum_before_rounding(spark):
    df = spark.createDataFrame([("a", 0.004)] * 1000 + [("a", float("nan")), ("a", None), ("a", float("inf"))], "region string, revenue double")
    row = reports.revenue_by_region(df).first()
    assert (row["orders"], row["revenue"]) == (1003, Decimal("4.00"))
    row = reports.summary_statistics(df.selectExpr("1 AS customer_id", "1 AS quantity", "revenue")).first()
    assert (row["total_revenue"], row["avg_order_value"]) == (Decimal("4.00"), Decimal("0.00"))
