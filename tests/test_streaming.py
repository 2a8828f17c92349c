"""Files streamed into a table, in several runs over one checkpoint."""

from datetime import datetime

import pytest

from tidemark.sinks.tables import Table
from tidemark.streaming.files import append_to, dedup_within, into_table, land_batch, run_available, stream_files, streaming_session
from tidemark.streaming.ledger import Ledger


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz", "string"])
def test_each_file_once_and_the_newest_row_of_a_key(spark, tmp_path, dtype):
    schema = f"id bigint, at {dtype}, val string"
    folder, rejects, checkpoint = (str(tmp_path / n) for n in ("in", "rejects", "checkpoint"))
    table = Table(spark, str(tmp_path / "table"), "id")

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)

    def run():
        run_available(into_table(stream_files(spark, folder, schema), table, "id", "at", 86400, rejects), checkpoint)
        return {r["id"]: r["val"] for r in table.read().collect()}

    def late():
        return sorted(r["id"] for r in spark.read.parquet(rejects).collect())

    def day(d, h=0):
        at = datetime(2024, 1, d, h)
        return at.isoformat() if dtype == "string" else at

    put([(1, day(1), "a"), (2, day(1), "b"), (1, day(1, 1), "newer")])
    assert run() == {1: "newer", 2: "b"}
    assert run() == {1: "newer", 2: "b"}  # nothing new
    put([(2, day(1, 6), "update inside the window"), (3, day(4), "c")])
    assert run() == {1: "newer", 2: "update inside the window", 3: "c"}
    assert late() == []
    put([(4, day(1), "behind the window"), (5, day(3, 12), "late, inside it"), (6, None, "no time")])
    assert run() == {1: "newer", 2: "update inside the window", 3: "c", 5: "late, inside it"}
    assert late() == [4, 6]


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz", "string"])
def test_keys_are_held_for_the_window(spark, tmp_path, dtype):
    schema = f"id bigint, at {dtype}, val string"
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def day(d):
        at = datetime(2024, 1, d)
        return at.isoformat() if dtype == "string" else at

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        files = stream_files(streaming_session(spark, 2), folder, schema)
        run_available(append_to(dedup_within(files, "id", "at", 3 * 86400), out), checkpoint)
        return sorted(((r["id"], r["val"]) for r in spark.read.parquet(out).collect()), key=repr)

    first = [(1, "a"), (2, "b"), (None, "n"), (None, "other")]
    assert run([(1, day(10), "a"), (2, day(10), "b"), (None, day(10), "n"), (None, day(10), "n"), (None, day(10), "other"), (9, None, "no time")]) == sorted(first, key=repr)
    # A key seen two days ago is held; one that is new but behind the watermark is left out.
    second = [*first, (3, "c")]
    assert run([(1, day(12), "again"), (3, day(12), "c"), (4, day(6), "late")]) == sorted(second, key=repr)
    # The state lets go of a key when the watermark is past it by the window.
    run([(5, day(25), "e")])
    run([(6, day(26), "f")])
    third = [*second, (5, "e"), (6, "f"), (1, "new life")]
    assert run([(1, day(25), "new life")]) == sorted(third, key=repr)


def test_a_batch_that_runs_twice_leaves_one_set_of_rejects(spark, tmp_path):
    schema = "id bigint, at timestamp, val string"
    table, rejects = Table(spark, str(tmp_path / "table"), "id"), str(tmp_path / "rejects")
    ledger = Ledger(spark, str(tmp_path / "batches"), "q")
    batches = [
        [(1, datetime(2024, 1, 1), "a")],
        [(2, datetime(2024, 1, 20), "b"), (3, datetime(2024, 1, 3), "inside"), (4, datetime(2023, 1, 1), "behind")],
    ]

    def land(n, to=ledger):
        land_batch(spark.createDataFrame(batches[n], schema), n, table, "id", "at", 5 * 86400, rejects, to)

    land(0)

    class Cut(Ledger):
        def entry(self, batch_id):
            found = super().entry(batch_id)

            class Stopped(type(found)):
                def note(self, step, mark=None):
                    if step == "done":
                        raise InterruptedError
                    super().note(step, mark)

            return Stopped(self.spark, found.path)

    with pytest.raises(InterruptedError):
        land(1, Cut(spark, ledger.path, "q"))
    # The table's mark is on the 20th now: judged anew, the row of the 3rd would be a reject.
    for _ in range(2):
        land(1)
        assert sorted(r["id"] for r in table.read().collect()) == [1, 2, 3]
        assert [r["id"] for r in spark.read.parquet(rejects).collect()] == [4]
    assert ledger.entry(1).reached("done") and not ledger.entry(2).reached("prepared")
    # Another query counts its batches for itself.
    other = Ledger(spark, ledger.path, "other")
    land_batch(spark.createDataFrame([(7, datetime(2024, 1, 19), "x")], schema), 1, table, "id", "at", 5 * 86400, rejects, other)
    assert table.row_count() == 4
