"""The gate: masks, counts, modes, and how it finds repeated keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.orders_gate import CHECKS, check_orders, orders_gate
from tidemark.plans.orders import typed_orders
from tidemark.plans.ingest import gate


def mask(spark, rows, schema, rules, key):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}")
    flagged = quality.flag_rows(df, rules, key).orderBy("_i").collect()
    return [set(r[quality.FAILED]) for r in flagged]


def test_mask_and_counts(spark):
    rows, rules = [(1, 10), (1, -5), (3, 20)], {"unique": ["id"], "positive": ["amount"]}
    assert mask(spark, rows, "id int, amount int", rules, "id") == [
        {"unique:id"},
        {"unique:id", "positive:amount"},
        set(),
    ]
    report = quality.inspect(spark.createDataFrame(rows, "id int, amount int"), rules, "id").report
    assert not report.passed
    assert (report.total, report.failures, report.bad_count) == (3, {"positive:amount": 1, "unique:id": 2}, 2)
    assert report.summary() == "2 of 3 rows break rules (positive:amount=1; unique:id=2)"


def test_clean_batch(spark):
    report = quality.inspect(spark.createDataFrame([(1, 1)], "id int, amount int"), {"positive": ["amount"]}, "id").report
    assert report.passed and report.bad_count == 0 and report.summary() == "0 of 1 rows break rules"


def test_missing_columns(spark):
    rules = {"not_null": ["gone"], "unique": ["gone"], "positive": ["gone"]}
    assert mask(spark, [(1,), (2,)], "id int", rules, "id") == [{"not_null:gone"}] * 2


def test_nulls_and_nan(spark):
    nan = float("nan")
    rows = [(1, 1.0), (2, nan), (None, None), (None, 2.0)]
    rules = {"not_null": ["x"], "unique": ["x"], "positive": ["x"]}
    assert mask(spark, rows, "id int, x double", rules, "id") == [
        set(),
        {"not_null:x", "positive:x", "unique:x"},
        {"not_null:x", "positive:x", "unique:x", "unique:id"},
        {"unique:id"},
    ]


def test_unique_text_against_brute_force(spark):
    random.seed(7)
    rows = [(i, random.choice(["a", "b", None, "c" * 5000, f"only-{i}", f"only-{i}"])) for i in range(500)]
    times = Counter(t for _, t in rows)
    want = {i for i, t in rows if times[t] > 1}
    df = spark.createDataFrame(rows, "id int, t string")
    gate_ = quality.inspect(df, {"unique": ["t"]}, "id")
    assert gate_.report.failures == {"unique:t": len(want)} and gate_.report.bad_count == len(want)
    assert {r["id"] for r in quality.bad_rows(gate_.flagged()).collect()} == want
    good = {r["id"] for r in quality.good_rows(gate_.flagged()).collect()}
    assert good == {i for i, _ in rows} - want


def test_unique_above_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_KEYS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select("id", (F.col("id") % 600).alias("k"))
        gate_ = quality.inspect(df, {"unique": ["k"]}, "id")
        plan = gate_.flagged()._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert quality.bad_rows(gate_.flagged()).count() == 800 == gate_.report.bad_count
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_uniqueness_never_moves_whole_rows(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, t string")
    flagged = quality.flag_rows(df, {"unique": ["t"]}, "id", broadcastable=["t", "id"])
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("BroadcastHashJoin") == 2


def test_report_frame_equals_inspect(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 5, None), (2, -1, "a"), (3, 3, "b")], "id int, n int, t string")
    rules = {"not_null": ["t"], "unique": ["t"], "positive": ["n"]}
    row = quality.report_frame(df, rules, "id").first().asDict()
    assert row == {
        "total": 4,
        "not_null_t": 1,
        "positive_n": 2,
        "unique_t": 2,
        "unique_id": 2,
        "bad_count": 3,
    }
    report = quality.inspect(df, rules, "id").report
    assert (report.total, report.bad_count) == (4, 3)
    assert report.failures == {"not_null:t": 1, "positive:n": 2, "unique:t": 2, "unique:id": 2}


def test_modes(spark):
    df = spark.createDataFrame([(1, -1), (2, 5)], "id int, n int")
    rules = {m: quality.Rules(positive=("n",), on_fail=m) for m in quality.ON_FAIL}
    with pytest.raises(quality.QualityError):
        gate("t", df, rules["abort"], "id")
    assert gate("t", df, rules["warn"], "id").good.count() == 2
    parts = gate("t", df, rules["quarantine"], "id")
    assert parts.good.count() + parts.rejects.count() == 2
    assert parts.rejects.first()[quality.FAILED] == ["positive:n"]
    with pytest.raises(ValueError):
        quality.Rules(on_fail="ignore")


# -- the orders gate ------------------------------------------------------------------------------

ORDERS = [
    (1001, "2024-01-05", "C017", "Wireless Mouse", "Accessories", "North", 3, 24.99),
    (1002, "2024-01-06", "C042", "Mechanical Keyboard", "Accessories", "West", 1, 89.50),
    (1003, "2024-01-08", "C019", "27-inch Monitor", "Displays", "North", 2, 219.00),
]
SCHEMA = (
    "order_id bigint, order_date string, customer_id string, product string, category string, "
    "region string, quantity bigint, unit_price double"
)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(ORDERS, SCHEMA)


def failing(report):
    return {name for name, ok in report.checks.items() if not ok}


def second(column, value):
    return F.when(F.col("order_id") == 1002, F.lit(value)).otherwise(F.col(column))


def test_clean_orders_pass(orders):
    report = check_orders(orders)
    assert report.passed and list(report.checks) == list(CHECKS) and not report.errors
    assert report.summary() == "3 orders passed all checks"


def test_missing_column_stops_the_checks(orders):
    report = check_orders(orders.drop("region"))
    assert report.checks == {"all_required_columns_present": False}
    assert report.errors == ["Missing columns: ['region']"]
    row = orders_gate(orders.drop("region")).first()
    assert row["all_required_columns_present"] is False and row["order_id_is_unique"] is None


@pytest.mark.parametrize(
    "column, value, check",
    [
        ("order_id", 1001, "order_id_is_unique"),
        ("unit_price", -1.0, "unit_price_positive"),
        ("quantity", 0, "quantity_positive"),
        ("customer_id", None, "no_nulls_in_required_fields"),
        ("order_date", "yesterday", "order_date_parses"),
    ],
)
def test_each_check(orders, column, value, check):
    broken = orders.withColumn(column, second(column, value))
    report = check_orders(broken)
    assert failing(report) == {check} and len(report.errors) == 1
    assert report.summary() == f"3 orders failed {check}: {report.errors[0]}"
    row = orders_gate(broken).first().asDict()
    assert {c for c in CHECKS if not row[c]} == {check}


def test_repeated_ids_count_beyond_the_first(spark, orders):
    report = check_orders(orders.union(orders).union(orders))
    assert report.errors == ["6 duplicate order_id value(s)"]
    nulls = orders.withColumn("order_id", F.lit(None).cast("bigint"))
    assert "2 duplicate order_id value(s)" in check_orders(nulls).errors


def test_revenue(orders):
    rows = typed_orders(orders).orderBy("order_id").collect()
    assert [r["revenue"] for r in rows] == [74.97, 89.5, 438.0]


# -- hot keys -------------------------------------------------------------------------------------


@pytest.mark.parametrize("few", [True, False])
def test_one_value_in_a_third_of_the_rows(spark, monkeypatch, few):
    """A value, and null, that each fill a third of the batch: by broadcast and by shuffle."""
    if not few:
        monkeypatch.setattr(quality, "BROADCAST_KEYS", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
        df = spark.range(30_000).select("id", hot.otherwise(F.col("id").cast("string")).alias("t"))
        outcome = quality.inspect(df, {"unique": ["t"], "on_fail": "quarantine"}, "id")
        assert outcome.report.failures == {"unique:t": 20_000}
        assert outcome.repeats == {"t": 2}
        flagged = outcome.flagged()
        assert quality.bad_rows(flagged).count() == 20_000
        assert quality.good_rows(flagged).where("id % 3 <> 2").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_keys_are_counted_before_the_shuffle(spark):
    plan = quality.repeated_keys(spark.range(10), "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
