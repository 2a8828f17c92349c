"""Bucketed catalog tables, footers, and the catalog."""

import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.plans.catalog import create_as_select, list_columns
from tidemark.sinks.bucketed import BucketedTable
from tidemark.sources.footers import footer_facts


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    table = BucketedTable(spark, f"t_{uuid.uuid4().hex}", "id", 4, str(tmp_path / "t"))
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def rows(spark, ids, val):
    return spark.createDataFrame([(i, val) for i in ids], "id bigint, val string")


def test_upsert_and_delete(spark, stored):
    assert not stored.exists()
    stored.upsert(rows(spark, [*range(20), None], "a"))
    stored.upsert(rows(spark, [*range(15, 30), None], "b"), dead=rows(spark, [3, 16, 99], "x"))
    found = sorted(((r.id, r.val) for r in stored.read().collect()), key=repr)
    expected = [(i, "a") for i in range(15) if i != 3] + [(i, "b") for i in range(15, 30) if i != 16] + [(None, "a"), (None, "b")]
    assert found == sorted(expected, key=repr)
    stored.upsert(rows(spark, [15], "c"))
    assert stored.read().count() == len(expected)
    assert stored.read().where("id = 15").first().val == "c"


def test_no_row_of_the_table_is_shuffled(spark, stored):
    stored.create(rows(spark, range(500), "a"))
    gone = BucketedTable(spark, f"{stored.name}_gone", "id", 4, stored.path)
    gone.create(rows(spark, range(0, 600, 3), "x").select("id"))
    stay = stored.staying(gone.name)
    plan = plan_of(stay)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert stay.count() == 500 - 167
    spark.sql(f"DROP TABLE {gone.name}")


def test_a_failed_upsert_leaves_the_table(spark, stored):
    stored.create(rows(spark, range(5), "a"))
    broken = rows(spark, [1], "b").withColumn("val", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        stored.upsert(broken)
    assert sorted(r.val for r in stored.read().collect()) == ["a"] * 5
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{stored.name}_gone")]


def test_counts_and_marks_come_from_footers(spark, tmp_path):
    spark.range(1000).selectExpr("id", "date'2024-01-01' + cast(id as int) AS at", "cast(id as string) AS name").write.parquet(f"{tmp_path}/p")
    found = footer_facts(spark, f"{tmp_path}/p", "id")
    assert tuple(found.first()) == (1000, 999)
    assert "PushedAggregation: [COUNT(*), MAX(id)]" in plan_of(found)
    assert str(footer_facts(spark, f"{tmp_path}/p", "at").first()[1]) == "2026-09-26"
    # Text has no exact maximum in a footer: the column is read.
    assert footer_facts(spark, f"{tmp_path}/p", "name").first()[1] == "999"
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_catalog_lists_what_a_query_made(spark, tmp_path):
    name = f"made_{uuid.uuid4().hex}"
    create_as_select(spark, name, spark.range(3).selectExpr("id", "cast(1.5 AS decimal(18,2)) AS amount"), f"{tmp_path}/c")
    assert [tuple(r) for r in list_columns(spark, name).collect()] == [(1, "id", "bigint"), (2, "amount", "decimal(18,2)")]
    create_as_select(spark, name, spark.range(5).selectExpr("id AS other"), f"{tmp_path}/c")
    assert [r.column_name for r in list_columns(spark, name).collect()] == ["other"]
    assert spark.table(name).count() == 5
    spark.sql(f"DROP TABLE {name}")
