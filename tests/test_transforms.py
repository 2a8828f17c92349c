"""Transforms and scalar rules on small fixtures."""

import math
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import scalars, transforms
from tidemark.operators.incremental import apply_lag, lagged, max_cursor, since
from tidemark.operators.reports import describe_columns


def one(df, column):
    return df.first()[column]


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, "x")], ["Order Id", " Name "])
    assert transforms.apply(["normalize_columns"], df).columns == ["order_id", "name"]


def test_derive_line_totals(spark):
    rows = [(100.0, 5), (1.0, 8), (3.0, 0), (None, 7), (2.0, None)]
    df = spark.createDataFrame(rows, "amount double, quantity int")
    out = transforms.apply(["derive_line_totals"], df).collect()
    assert [r["unit_price_effective"] for r in out] == [20.0, 0.12, None, None, None]
    assert [r["is_bulk"] for r in out] == [True, True, False, True, False]
    assert transforms.apply(["derive_line_totals"], df.select("amount")).columns == ["amount"]


def test_trim_strings_strips_what_python_strips(spark):
    texts = [" a ", "\t\nb c\r\n", "　d\xa0", "\x1ce\x1f", "", "   ", None, "inner  space"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = transforms.apply(["trim_strings"], df).orderBy("i").collect()
    assert [r["t"] for r in out] == [t if t is None else t.strip() for t in texts]
    assert [r["i"] for r in out] == list(range(len(texts)))


def test_trim_strings_on_random_text(spark):
    texts = st.text(alphabet=st.sampled_from(scalars.WHITESPACE + "abc"), max_size=12)

    @settings(max_examples=3, deadline=None)
    @given(st.lists(texts, min_size=200, max_size=300))
    def check(values):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(values)], "i int, t string")
        out = transforms.trim_strings(df).orderBy("i").collect()
        assert [r["t"] for r in out] == [t.strip() for t in values]

    check()


def test_ingested_at_is_fixed_once(spark):
    df = transforms.apply(["add_ingested_at"], spark.range(3))
    first, second = df.collect(), df.collect()
    assert first == second
    stamp = {r["_ingested_at"] for r in first}
    assert len(stamp) == 1
    assert datetime.fromisoformat(stamp.pop()).tzinfo == timezone.utc


def test_registry():
    assert {"normalize_columns", "trim_strings", "add_ingested_at", "derive_line_totals"} <= set(
        transforms.registered()
    )
    with pytest.raises(KeyError):
        transforms.apply(["does_not_exist"], None)
    with pytest.raises(ValueError):
        transforms.transform("trim_strings")(lambda df: df)


def test_own_transform_runs_in_order(spark):
    @transforms.transform("test_mask_pii")
    def mask(df):
        return transforms.mask_pii(df)

    df = spark.createDataFrame([(" Ann@Mail.example ",)], ["Email"])
    out = transforms.apply(["normalize_columns", "trim_strings", "test_mask_pii"], df)
    assert one(out, "email") == "Ann@***"


def test_cast_money_ignores_absent_columns(spark):
    df = transforms.cast_money(spark.createDataFrame([(74.97, 1)], "amount double, q int"), ["AMOUNT", "nope"])
    assert df.columns == ["amount", "q"]
    assert one(df, "amount") == Decimal("74.97")


def test_lineage_ids_follow_the_content(spark):
    rows = [(1, "a", None), (1, None, "a"), (1, "a", None), (2, "a", None)]
    df = transforms.add_lineage(spark.createDataFrame(rows, "i int, a string, b string"), "L1")
    ids = [r["_row_id"] for r in df.collect()]
    assert ids[0] == ids[2] and len(set(ids)) == 3
    assert {r["_load_id"] for r in df.collect()} == {"L1"}


def test_round_cents_ties_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "x double")
    assert [r[0] for r in df.select(scalars.round_cents(F.col("x"))).collect()] == [0.12, 0.38, 2.5]


def test_flags(spark):
    cases = {
        "int": [(1, True), (0, False), (None, False), (2, True)],
        "boolean": [(True, True), (False, False), (None, False)],
        "double": [(1.0, True), (0.0, False), (float("nan"), False)],
        "string": [("true", True), (" false ", False), ("1", True), ("maybe", False), (None, False)],
    }
    for dtype, values in cases.items():
        df = spark.createDataFrame([(v,) for v, _ in values], f"f {dtype}")
        out = df.select(scalars.is_flagged(F.col("f"), df.schema["f"].dataType)).collect()
        assert [r[0] for r in out] == [want for _, want in values], dtype


def test_apply_lag():
    assert apply_lag("2024-01-15T16:20:00", 86400) == "2024-01-14T16:20:00"
    assert apply_lag(1000, 100) == 900
    assert apply_lag(Decimal("10.5"), 1) == Decimal("9.5")
    assert apply_lag(None, 100) is None
    assert apply_lag("2024-01-15T16:20:00", 0) == "2024-01-15T16:20:00"
    assert apply_lag("not a time", 5) == "not a time"
    assert apply_lag(True, 5) is True
    assert apply_lag(datetime(2024, 1, 15, 16, 20), 60) == datetime(2024, 1, 15, 16, 19)
    assert apply_lag(date(2024, 1, 15), 86401) == date(2024, 1, 13)


def test_lagged_column_equals_the_scalar(spark):
    texts = ["2024-01-15T16:20:00", "not a time"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    out = df.select(lagged(F.col("c"), df.schema["c"].dataType, 86400)).collect()
    assert [r[0] for r in out] == [apply_lag(t, 86400) for t in texts]
    df = spark.sql("select timestamp_ntz'2024-01-15 16:20:00' c, 1000L n")
    row = df.select(
        lagged(F.col("c"), df.schema["c"].dataType, 60).alias("c"), lagged(F.col("n"), df.schema["n"].dataType, 60).alias("n")
    ).first()
    assert row["c"] == datetime(2024, 1, 15, 16, 19) and row["n"] == 940


def test_since_is_closed_typed_and_drops_nulls(spark):
    df = spark.createDataFrame([(9,), (10,), (11,), (None,)], "c int")
    assert [r[0] for r in since(df, "c", 10).collect()] == [10, 11]
    assert since(df, "c", None).count() == 4
    assert since(df, None, 10).count() == 4
    assert since(df, "absent", 10).count() == 4


def test_max_cursor_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "c double")
    assert max_cursor(df, "c") == 1.0
    assert max_cursor(df.limit(0), "c") is None


def test_describe_columns(spark):
    df = spark.createDataFrame([(1, "a", 1.5)], "id bigint, val string, amount double")
    rows = describe_columns(df).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [(1, "id", "bigint"), (2, "val", "string"), (3, "amount", "double")]


def test_positive_treats_nan_as_bad(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (math.nan,), (None,)], "x double")
    out = df.select(scalars.is_positive(F.col("x"), df.schema["x"].dataType)).collect()
    assert [r[0] for r in out] == [True, False, False, False, False]
