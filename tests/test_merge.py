"""Upsert and delete as frames, against a dictionary."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import merge

SCHEMA = "id bigint, val bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(((r["id"], r["val"]) for r in df.collect()), key=repr)


def test_changes_against_a_dictionary(spark):
    keys = st.integers(0, 30)
    tables = st.dictionaries(keys, st.integers(0, 99), max_size=20)

    @settings(max_examples=6, deadline=None)
    @given(tables, tables, st.sets(keys, max_size=8), st.sampled_from([None, 10, 10**9]))
    def check(target, batch, dead, key_rows):
        t, b = frame(spark, list(target.items())), frame(spark, list(batch.items()))
        d = frame(spark, [(k, 0) for k in dead])
        after = {**target, **batch}
        assert rows_of(merge.upsert(t, b, "id", key_rows)) == sorted(after.items(), key=repr)
        left = {k: v for k, v in after.items() if k not in dead}
        once = merge.apply_changes(t, b, d, "id", key_rows)
        assert rows_of(once) == sorted(left.items(), key=repr)
        assert rows_of(merge.apply_changes(once, b, d, "id", key_rows)) == rows_of(once)

    check()


def test_null_keys_of_both_sides_stay(spark):
    t, b = frame(spark, [(None, 1), (1, 1)]), frame(spark, [(None, 2), (1, 2)])
    assert rows_of(merge.upsert(t, b, "id")) == [(1, 2), (None, 1), (None, 2)]


def test_newest_version_per_key(spark):
    rows = [(1, 5), (1, 9), (1, 7), (2, None), (2, 1), (None, 3), (None, 3), (3, None)]
    assert rows_of(merge.latest_by_key(frame(spark, rows), "id", "val")) == [
        (1, 9),
        (2, 1),
        (3, None),
        (None, 3),
        (None, 3),
    ]


def test_newest_version_of_a_hot_key(spark):
    """One key holds nearly all rows: each task sends one of them on."""
    df = spark.range(50_000).select(
        F.when(F.col("id") < 49_000, 7).otherwise(F.col("id")).alias("id"), F.col("id").alias("val")
    )
    newest = merge.latest_by_key(df, "id", "val")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan
    assert newest.count() == 1001
    assert newest.where("id = 7").first()["val"] == 48_999


def test_equal_cursors_are_decided_the_same_way_each_time(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 1, "c")], "id int, at int, val string")
    for parts in (1, 3):
        assert merge.latest_by_key(df.repartition(parts), "id", "at").first()["val"] == "c"


def test_a_batch_without_repeats_is_passed_on(spark):
    df = frame(spark, [(1, 1), (2, 1), (None, 1), (None, 1)])
    assert merge.one_row_per_key(df, "id", None) is df
    with pytest.raises(merge.DuplicateKeys):
        merge.one_row_per_key(frame(spark, [(1, 1), (1, 2)]), "id", None)


def test_conform_takes_the_order_and_types_of_the_table(spark):
    target = spark.createDataFrame([], "a bigint, b decimal(18,2)")
    df = merge.conform(spark.createDataFrame([(1.5, 1)], "B double, A int"), target.schema)
    assert df.dtypes == [("a", "bigint"), ("b", "decimal(18,2)")]
    with pytest.raises(ValueError, match="unknown .'c'"):
        merge.conform(spark.createDataFrame([(1.5, 1, 1)], "b double, a int, c int"), target.schema)


def test_a_bitmap_of_keys_keeps_most_rows_out_of_the_shuffle(spark, tmp_path):
    """Sizes as of a key set that is too large to broadcast."""
    target = spark.range(200_000).withColumn("val", F.col("id") * 2)
    target = target.unionByName(spark.range(50).select(F.lit(None).cast("bigint").alias("id"), F.col("id").alias("val")))
    keys = spark.range(0, 400_000, 40).select("id").unionByName(spark.range(3).select(F.lit(None).cast("bigint").alias("id")))
    clear, suspect = merge.split_by_bitmap(target, keys, "id", merge.bitmap_bits(10_000))
    hits = spark.range(0, 200_000, 40).count()
    assert hits <= suspect.count() < hits + 0.05 * 200_000
    assert clear.count() + suspect.count() == target.count()
    assert suspect.where("id IS NULL").count() == 0
    left = merge.without_many_keys(target, keys, "id", 10_000)
    assert sorted(left.collect(), key=repr) == sorted(target.join(keys, "id", "left_anti").collect(), key=repr)


def test_a_bitmap_of_compound_and_text_keys(spark):
    rows = [(i % 50, f"k{i}", i) for i in range(500)] + [(None, "k1", 0), (1, None, 0)]
    target = spark.createDataFrame(rows, "a int, b string, v int")
    keys = target.where("v % 7 = 0").select("a", "b")
    left = merge.without_many_keys(target, keys, ["a", "b"], 72)
    assert sorted(left.collect(), key=repr) == sorted(target.join(keys, ["a", "b"], "left_anti").collect(), key=repr)
    assert merge.bitmap_bits(1 << 40) == merge.MOST_BITS and merge.bitmap_bits(0) == merge.LEAST_BITS
