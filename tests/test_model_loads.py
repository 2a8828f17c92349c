"""Random histories of a source, loaded step by step, against the same steps on a dictionary."""

import random

import pytest

from tidemark.plans.ingest import run_ingest
from tidemark.plans.lake import Lake
from tidemark.plans.specs import parse_spec
from test_ingest import put

COLUMNS = "id int, val int, is_deleted int, at int"
LAG = 5


def changed(source, rng, now):
    """The source some time later: new rows, updates, deletes by flag, and rows that come late."""
    after = dict(source)
    for _ in range(rng.randint(0, 8)):
        at = now + rng.randint(0, 3) - (rng.randint(0, 9) if rng.random() < 0.3 else 0)
        after[rng.randint(0, 25)] = (rng.randint(-2, 9), int(rng.random() < 0.25), at)
    return after


def loaded(table, source):
    """The table after a load, and the number of rows that passed the gate."""
    mark = max((at for _, _, at in table.values()), default=None)
    batch = {k: r for k, r in source.items() if mark is None or r[2] >= mark - LAG}
    good = {k: r for k, r in batch.items() if not r[1] and r[0] > 0}
    dead = {k for k, r in batch.items() if r[1]}
    return {k: r for k, r in {**table, **good}.items() if k not in dead}, len(good)


@pytest.mark.parametrize("seed, layout", [(1, {"buckets": 3}), (2, {"bucket_width": 7})])
def test_loads_equal_the_dictionary(spark, tmp_path, seed, layout):
    rng, lake = random.Random(seed), Lake(spark, str(tmp_path / "lake"))
    spec = parse_spec(
        {
            "kind": "ingest",
            "name": "t",
            "source": {"type": "csv", "path": str(tmp_path / "t.csv"), "columns": COLUMNS},
            "extract": {"incremental_cursor": "at", "lag_seconds": LAG},
            "target": {"table": "t", "primary_key": "id", "soft_delete_column": "is_deleted", **layout},
            "quality": {"positive": ["val"], "on_fail": "quarantine"},
        }
    )
    source, table = {}, {}
    for step in range(5):
        source = changed(source, rng, step * 4)
        put(tmp_path / "t.csv", COLUMNS, [(k, *r) for k, r in source.items()])
        table, written = loaded(table, source)
        assert run_ingest(lake, spec) == written
        stored = lake.silver("t")
        if stored.exists():
            rows = {r["id"]: (r["val"], r["is_deleted"], r["at"]) for r in stored.read().collect()}
            assert rows == table and stored.row_count() == len(table)
        else:
            assert not table
