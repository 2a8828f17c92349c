"""Stored tables: overwrite, append, upsert, delete, lookup, and what stays when a load fails."""

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import DuplicateKeys
from tidemark.session import landed
from tidemark.sinks import tables
from tidemark.sinks.tables import Table, TooManyBuckets, write


def frame(spark, rows, schema="id bigint, val string, amount double"):
    return spark.createDataFrame(rows, schema)


def content(table):
    return sorted((tuple(r) for r in table.read().collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, str(tmp_path / "t"), "id", buckets=4)


def test_first_merge_creates_the_table(spark, table):
    assert not table.exists() and table.row_count() == 0
    assert write(table, frame(spark, [(1, "a", 1.0), (2, "b", 2.0)]), "merge", "id") == 2
    assert table.row_count() == 2
    assert content(table) == [(1, "a", 1.0), (2, "b", 2.0)]


def test_merge_updates_all_columns_and_inserts(spark, table):
    write(table, frame(spark, [(1, "a", 1.0), (2, "b", 2.0)]), "merge", "id")
    write(table, frame(spark, [(2, "B", 9.0), (3, "c", 3.0)]), "merge", "id")
    assert content(table) == [(1, "a", 1.0), (2, "B", 9.0), (3, "c", 3.0)]
    assert table.row_count() == 3


def test_merge_twice_is_the_same(spark, table):
    batch = frame(spark, [(i, f"v{i}", float(i)) for i in range(50)])
    write(table, batch, "merge", "id")
    before = content(table)
    write(table, batch, "merge", "id")
    assert content(table) == before


def test_merge_needs_a_key(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        write(table, frame(spark, [(1, "a", 1.0)]), "merge")
    with pytest.raises(ValueError):
        write(table, frame(spark, [(1, "a", 1.0)]), "upsert")


def test_repeated_keys_keep_the_newest_or_raise(spark, table):
    batch = frame(spark, [(1, "old", 1.0), (1, "new", 2.0), (2, "x", 0.0)])
    with pytest.raises(DuplicateKeys):
        write(table, batch, "merge", "id")
    write(table, batch, "merge", "id", cursor="amount")
    assert content(table) == [(1, "new", 2.0), (2, "x", 0.0)]


def test_null_keys_match_nothing(spark, table):
    write(table, frame(spark, [(1, "a", 1.0), (None, "n", 0.0)]), "merge", "id")
    write(table, frame(spark, [(None, "m", 0.0), (1, "A", 1.0)]), "merge", "id")
    assert content(table) == [(1, "A", 1.0), (None, "m", 0.0), (None, "n", 0.0)]


def files_of(table):
    """Files by bucket, with the time each was written."""
    found = {}
    for bucket in (d for d in os.listdir(table.path) if d.startswith("_bucket=")):
        names = [f for f in os.listdir(f"{table.path}/{bucket}") if f.endswith(".parquet")]
        found[bucket.removeprefix("_bucket=")] = sorted(names)
    return found


def test_merge_leaves_other_buckets_alone(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "id", width=100)
    write(table, frame(spark, [(i, "a", 1.0) for i in range(1000)]), "merge", "id")
    first = files_of(table)
    assert set(first) == {str(b) for b in range(10)}
    write(table, frame(spark, [(950, "b", 2.0), (1001, "c", 3.0)]), "merge", "id")
    second = files_of(table)
    assert {b for b in first if second[b] == first[b]} == {str(b) for b in range(9)}
    assert set(second) - set(first) == {"10"} and second["9"] != first["9"]
    assert table.row_count() == 1001 == table.read().count()
    assert table.lookup(id=950).collect()[0]["val"] == "b"


def test_a_table_is_plain_parquet(spark, table):
    write(table, frame(spark, [(i, "a", 1.0) for i in range(20)] + [(None, "n", 0.0)]), "merge", "id")
    plain = spark.read.parquet(table.path)
    assert sorted(plain.columns) == sorted([*table.read().columns, "_bucket"]) and plain.count() == 21
    assert {n for n in os.listdir(table.path) if "=" not in n and not n.startswith(".")} <= {"_layout", "_SUCCESS"}


def test_upsert_does_not_shuffle_the_table(spark, table):
    from tidemark.operators.merge import change_parts

    write(table, frame(spark, [(i, "a", 1.0) for i in range(100)]), "merge", "id")
    batch = frame(spark, [(1, "b", 1.0)])
    stay, _ = change_parts(table.read(), batch, batch.limit(0), "id", key_rows=1)
    plan = stay._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_large_key_sets_are_not_broadcast(spark, table, tmp_path, monkeypatch):
    from tidemark.operators import merge

    monkeypatch.setattr(merge, "BROADCAST_KEYS", 1)
    monkeypatch.setattr(tables, "BROADCAST_KEYS", 1)
    for t in (table, Table(spark, str(tmp_path / "ranges"), "id", width=40)):
        write(t, frame(spark, [(i, "a", 1.0) for i in range(100)] + [(None, "n", 0.0)]), "merge", "id")
        write(t, frame(spark, [(i, "b", 2.0) for i in range(50, 150)] + [(None, "m", 0.0)]), "merge", "id")
        t.delete(frame(spark, [(i,) for i in range(10)], "id int"))
        assert content(t) == sorted(
            [(i, "a", 1.0) for i in range(10, 50)]
            + [(i, "b", 2.0) for i in range(50, 150)]
            + [(None, "m", 0.0), (None, "n", 0.0)],
            key=repr,
        )


def test_delete_keys(spark, table):
    table.delete(frame(spark, [(1,)], "id int"))  # no table: nothing happens
    write(table, frame(spark, [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)]), "merge", "id")
    table.delete(frame(spark, [(2,), (7,), (None,)], "id int"))
    assert content(table) == [(1, "a", 1.0), (3, "c", 3.0)]
    table.delete(frame(spark, [(1,), (3,)], "id int"))
    assert content(table) == [] and table.row_count() == 0
    write(table, frame(spark, [(5, "e", 5.0)]), "merge", "id")
    assert content(table) == [(5, "e", 5.0)]


def test_merge_and_delete_in_one_write(spark, table, monkeypatch):
    write(table, frame(spark, [(1, "a", 1.0), (2, "b", 2.0)]), "merge", "id")
    writes, write_rows = [], Table._write
    monkeypatch.setattr(Table, "_write", lambda self, *a, **k: writes.append(write_rows(self, *a, **k)) or writes[-1])
    table.merge(frame(spark, [(1, "A", 1.0), (3, "c", 3.0)]), frame(spark, [(2,), (3,)], "id bigint"))
    assert len(writes) == 1
    assert content(table) == [(1, "A", 1.0)]


def test_overwrite_from_itself_and_with_a_new_schema(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    table.overwrite(frame(spark, [(1, "a", 1.0), (2, "b", 2.0)]))
    assert table.overwrite(table.read().where("id = 2").withColumn("more", F.lit(1))) == 1
    assert content(table) == [(2, "b", 2.0, 1)]


def test_append(spark, tmp_path):
    for table in (Table(spark, str(tmp_path / "plain")), Table(spark, str(tmp_path / "keyed"), "id")):
        assert table.append(frame(spark, [(1, "a", 1.0)])) == 1
        assert table.append(frame(spark, [(1, "b", 2.0), (2, "c", 3.0)])) == 2
        assert content(table) == [(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0)]
        assert table.row_count() == 3


def test_append_and_delete(spark, table):
    table.append(frame(spark, [(1, "a", 1.0), (2, "b", 2.0)]))
    table.append_and_delete(frame(spark, [(3, "c", 3.0), (2, "d", 4.0)]), frame(spark, [(2,)], "id bigint"), "id")
    assert content(table) == [(1, "a", 1.0), (3, "c", 3.0)]


def test_money_is_stored_exactly(spark, table):
    write(table, frame(spark, [(1, "a", 74.97), (2, "b", None)]), "merge", "id", money_columns=["amount", "absent"])
    assert table.read().schema["amount"].dataType == T.DecimalType(18, 2)
    write(table, frame(spark, [(2, "b", 0.1)]), "merge", "id")  # the table's type wins
    assert table.read().schema["amount"].dataType == T.DecimalType(18, 2)
    assert [str(r[2]) for r in sorted(table.read().collect())] == ["74.97", "0.10"]


def test_a_batch_that_does_not_fit_changes_nothing(spark, table):
    write(table, frame(spark, [(1, "a", 1.0)]), "merge", "id")
    with pytest.raises(ValueError):
        write(table, spark.createDataFrame([(2, 3)], "id bigint, other int"), "merge", "id")
    assert content(table) == [(1, "a", 1.0)]


def test_a_failed_write_leaves_the_old_rows(spark, table):
    write(table, frame(spark, [(1, "a", 1.0)]), "merge", "id")
    broken = frame(spark, [(2, "b", 1.0)]).withColumn("amount", F.raise_error(F.lit("lost")).cast("double"))
    for attempt in (table.merge, table.overwrite, table.append):
        with pytest.raises(Exception):
            attempt(broken)
        assert content(table) == [(1, "a", 1.0)]


def test_rows_are_counted_by_the_write_also_if_a_task_runs_again(spark, table, tmp_path):
    """A task that fails once is run again: its rows count once."""
    mark = str(tmp_path / "failed")

    def fail_once(batches):
        import os

        for batch in batches:
            yield batch
            if not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("lost once")

    rows = frame(spark, [(i, "a", 1.0) for i in range(1000)])
    plain = Table(spark, str(tmp_path / "plain"))
    if spark.sparkContext.master.endswith("]"):  # local masters run a task once
        with pytest.raises(Exception):
            plain.overwrite(rows.mapInArrow(fail_once, rows.schema))
    assert plain.overwrite(rows.mapInArrow(fail_once, rows.schema)) == 1000 == plain.row_count()
    assert table.overwrite(rows) == 1000 and table.append(rows.limit(7)) == 7
    assert table.row_count() == 1007


def test_max_cursor_ignores_nan_and_missing_tables(spark, table):
    assert table.max_cursor("amount") is None
    write(table, frame(spark, [(1, "a", 1.0), (2, "b", float("nan"))]), "merge", "id")
    assert table.max_cursor("AMOUNT") == 1.0
    assert table.max_cursor("no_such") is None


CURSORS = {
    "bigint": [9, 10, 8],
    "double": [1.5, float("nan"), 0.1],
    "decimal(18,2)": [Decimal("9.99"), Decimal("10.00"), None],
    "string": ["2024-01-02T00:00:00", "2024-01-10T00:00:00", None],
    "date": [date(2024, 1, 2), date(2024, 1, 10), None],
    "timestamp": [datetime(2024, 1, 2), datetime(2024, 1, 10, 1, 2, 3, 456789), None],
    "timestamp_ntz": [datetime(2024, 1, 2), datetime(2024, 1, 10, 1, 2, 3, 456789), None],
    "boolean": [None, None, None],
}


@pytest.mark.parametrize("dtype", CURSORS)
def test_the_mark_follows_the_rows(spark, tmp_path, dtype):
    table = Table(spark, str(tmp_path / "t"), "id", buckets=2)
    values = CURSORS[dtype]
    write(table, frame(spark, list(enumerate(values)), f"id bigint, at {dtype}"), "merge", "id")
    assert table.max_cursor("At") == max((v for v in values if v is not None and v == v), default=None)
    # It goes back when the row that carried it is deleted.
    table.delete(frame(spark, [(1,)], "id bigint"))
    rest = [v for i, v in enumerate(values) if i != 1 and v is not None and v == v]
    assert table.max_cursor("At") == max(rest, default=None)


def test_text_and_compound_keys(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), ["id", "val"], buckets=3)
    write(table, frame(spark, [(1, "a", 1.0), (1, "b", 2.0)]), "merge", ["id", "val"])
    write(table, frame(spark, [(1, "b", 5.0), (2, "a", 6.0)]), "merge", ["id", "val"])
    assert content(table) == [(1, "a", 1.0), (1, "b", 5.0), (2, "a", 6.0)]
    assert [r["amount"] for r in table.lookup(id=1, val="b").collect()] == [5.0]


def test_buckets_follow_the_size_of_the_first_load(spark, tmp_path, monkeypatch):
    from tidemark.sinks import tables

    small = Table(spark, str(tmp_path / "small"), "id")
    small.overwrite(spark.range(10))
    assert small.layout().buckets == tables.LEAST_BUCKETS
    monkeypatch.setattr(tables, "BUCKET_BYTES", 400)  # of eight bytes a row
    large = Table(spark, str(tmp_path / "large"), "id")
    large.overwrite(spark.range(1000))
    assert tables.LEAST_BUCKETS < large.layout().buckets < 40
    assert large.lookup(id=77).count() == 1


def test_a_first_load_writes_few_files_per_bucket(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "id", buckets=8)
    table.overwrite(spark.range(0, 20_000, 1, 16))
    assert table._spread(table.layout()) == 16
    assert [len(files) for files in files_of(table).values()] == [1] * 8
    rows = [r["id"] for r in spark.read.parquet(f"{table.path}/_bucket=3").collect()]
    assert rows == sorted(rows)


def test_buckets_follow_the_bytes_of_rows_not_an_estimate(spark, tmp_path, monkeypatch):
    """A join has an estimate far from its size, and a table in memory has none."""
    monkeypatch.setattr(tables, "BUCKET_BYTES", 1 << 20)
    rows = spark.range(2000).withColumnRenamed("id", "k")
    rows.write.parquet(f"{tmp_path}/rows")
    scan = spark.read.parquet(f"{tmp_path}/rows")
    joined = scan.join(scan.withColumnRenamed("k", "k"), "k").join(scan, "k")
    for name, df in (("scan", scan), ("join", joined), ("memory", rows)):
        table = Table(spark, f"{tmp_path}/{name}", "k")
        table.overwrite(df)
        assert table.layout().buckets == tables.LEAST_BUCKETS
        assert table.row_count() == 2000


def test_long_keys_and_null_keys(spark, tmp_path, monkeypatch):
    """Keys are broadcast by their bytes; rows without a key stay where they are."""
    monkeypatch.setattr(tables, "BROADCAST_BYTES", 10_000)
    table = Table(spark, f"{tmp_path}/t", "k", buckets=2)
    long = spark.range(50).selectExpr("concat(repeat('x', 2000), id) AS k", "id AS v")
    nulls = spark.range(900).selectExpr("cast(null AS string) AS k", "id AS v")
    table.overwrite(long.unionByName(nulls))
    with landed(long.withColumn("v", F.col("v") + 1000).unionByName(nulls.limit(10))) as batch:
        table.merge(batch)
    found = table.read()
    assert found.where("k IS NULL").count() == 910
    assert found.where("k IS NOT NULL AND v >= 1000").count() == found.where("k IS NOT NULL").count() == 50


def test_many_appends_are_compacted(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "id", buckets=4)
    for i in range(6):
        table.append(spark.range(i * 10, i * 10 + 10))
    assert max(map(len, files_of(table).values())) >= 5
    assert table.compact(most=6) == 0
    assert table.compact(most=4) >= 1
    assert max(map(len, files_of(table).values())) <= 4
    assert sorted(r.id for r in table.read().collect()) == list(range(60))
    assert (table.row_count(), table.max_cursor("id")) == (60, 59)


def test_ranges_too_narrow_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sinks.tables.MOST_BUCKETS", 20)
    table = Table(spark, str(tmp_path / "t"), "id", width=10)
    table.overwrite(spark.range(200))
    with pytest.raises(TooManyBuckets):
        table.merge(spark.range(1000))
    with pytest.raises(TooManyBuckets):
        table.overwrite(spark.range(1000))
    assert table.row_count() == 200
