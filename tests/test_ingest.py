"""Whole loads: CSV and database sources, gate modes, lag, deletes, the mart, and the orders loads."""

import csv
import os
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import QualityError, Rules
from tidemark.operators.reports import bi_report
from tidemark.plans import orders as orders_load
from tidemark.plans.ingest import run_ingest
from tidemark.plans.lake import Lake
from tidemark.plans.mart import SALES_MART, SALES_MART_SQL
from tidemark.plans.model import query
from tidemark.plans.run import run_all, run_job
from tidemark.plans.specs import Ingest, Specs, load_specs, parse_spec
from tidemark.sinks.exports import export_parquet

# The rows and jobs that the expected results belong to (FIXTURES.md).
CUSTOMERS = [
    (1, "Acme Corp", "North", "2023-06-01", "2024-01-01T00:00:00"),
    (2, "Globex", "West", "2023-08-14", "2024-01-01T00:00:00"),
    (3, "Initech", "South", "2023-11-02", "2024-01-02T00:00:00"),
    (4, "Umbrella Ltd", "East", "2024-01-05", "2024-01-05T00:00:00"),
]
CUSTOMER_COLUMNS = "customer_id int, name string, region string, signup_date string, updated_at string"
TRANSACTIONS = [
    (5001, 1, "SKU-MOUSE", 3, 74.97, "2024-01-05", "2024-01-05T09:00:00"),
    (5002, 2, "SKU-KEYB", 1, 89.50, "2024-01-06", "2024-01-06T10:30:00"),
    (5003, 1, "SKU-MON27", 2, 438.00, "2024-01-08", "2024-01-08T14:15:00"),
    (5004, 3, "SKU-HUB", 5, 199.75, "2024-01-11", "2024-01-11T08:45:00"),
    (5005, 4, "SKU-KEYB", 2, 179.00, "2024-01-15", "2024-01-15T16:20:00"),
]
TRANSACTION_COLUMNS = (
    "txn_id int, customer_id int, product_sku string, quantity int, amount double, txn_ts string, updated_at string"
)
PRODUCTS = [
    ("SKU-MOUSE", "Wireless Mouse", "Accessories", 12.00),
    ("SKU-KEYB", "Mechanical Keyboard", "Accessories", 45.00),
    ("SKU-MON27", "27-inch Monitor", "Displays", 130.00),
    ("SKU-HUB", "USB-C Hub", "Accessories", 18.00),
]
PRODUCT_COLUMNS = "product_sku string, product_name string, category string, unit_cost double"


def names(columns):
    return [c.split()[0] for c in columns.split(", ")]


def put_csv(path, columns, rows):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(columns)
        out.writerows(rows)


def put(path, columns, rows):
    put_csv(path, names(columns), rows)


def docs(folder):
    """The three ingests and the mart as declared jobs."""
    source = lambda name, columns: {"type": "csv", "path": f"{folder}/{name}.csv", "columns": columns}
    return [
        {
            "kind": "ingest",
            "name": "customers",
            "source": source("customers", CUSTOMER_COLUMNS),
            "extract": {"incremental_cursor": "updated_at"},
            "target": {"table": "customers", "primary_key": "customer_id", "buckets": 2},
            "transforms": ["normalize_columns", "trim_strings", "add_ingested_at"],
            "quality": {"not_null": ["customer_id", "updated_at"], "unique": ["customer_id"], "on_fail": "abort"},
        },
        {
            "kind": "ingest",
            "name": "products",
            "source": source("products", PRODUCT_COLUMNS),
            "target": {"table": "products", "primary_key": "product_sku", "buckets": 2},
            "transforms": ["normalize_columns", "trim_strings", "add_ingested_at"],
            "money_columns": ["unit_cost"],
        },
        {
            "kind": "ingest",
            "name": "transactions",
            "source": source("transactions", TRANSACTION_COLUMNS),
            "extract": {"incremental_cursor": "updated_at", "lag_seconds": 86400},
            "target": {"table": "transactions", "primary_key": "txn_id", "bucket_width": 1000},
            "transforms": ["normalize_columns", "derive_line_totals", "add_ingested_at"],
            "money_columns": ["amount"],
            "quality": {
                "not_null": ["txn_id", "updated_at"],
                "positive": ["amount", "quantity"],
                "on_fail": "quarantine",
            },
        },
    ]


@pytest.fixture
def folder(tmp_path):
    put(tmp_path / "customers.csv", CUSTOMER_COLUMNS, CUSTOMERS)
    put(tmp_path / "transactions.csv", TRANSACTION_COLUMNS, TRANSACTIONS)
    put(tmp_path / "products.csv", PRODUCT_COLUMNS, PRODUCTS)
    return tmp_path


@pytest.fixture
def specs(folder):
    specs = Specs()
    for doc in docs(folder):
        specs.add(doc)
    specs.add(SALES_MART)
    return specs


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def put_transactions(folder, rows):
    put(folder / "transactions.csv", TRANSACTION_COLUMNS, rows)


def test_full_run_rerun_and_update(spark, folder, lake, specs):
    assert run_all(lake, specs, parallel=3) == {"customers": 4, "products": 4, "transactions": 5, "sales_mart": 5}
    mart = lake.gold("sales_mart").read()
    rows = {
        r["txn_id"]: (r["region"], r["category"], r["quantity"], *(str(r[c]) for c in ("revenue", "cost", "gross_margin")))
        for r in mart.collect()
    }
    assert rows == {
        5001: ("North", "Accessories", 3, "74.97", "36.00", "38.97"),
        5002: ("West", "Accessories", 1, "89.50", "45.00", "44.50"),
        5003: ("North", "Displays", 2, "438.00", "260.00", "178.00"),
        5004: ("South", "Accessories", 5, "199.75", "90.00", "109.75"),
        5005: ("East", "Accessories", 2, "179.00", "90.00", "89.00"),
    }
    assert mart.schema["gross_margin"].dataType == T.DecimalType(18, 2)
    assert mart.schema["txn_date"].dataType == T.DateType()

    # A second run changes nothing.
    run_all(lake, specs)
    assert lake.silver("transactions").row_count() == 5

    # A changed row is updated in place, and the mart follows.
    changed = [r if r[0] != 5002 else (5002, 2, "SKU-KEYB", 9, 805.5, "2024-01-06", "2024-03-01T00:00:00") for r in TRANSACTIONS]
    put_transactions(folder, changed)
    run_all(lake, specs)
    assert lake.silver("transactions").row_count() == 5
    assert lake.gold("sales_mart").read().where("txn_id = 5002").first()["quantity"] == 9

    # The exported file serves the report without the lake.
    path = export_parquet(lake.gold("sales_mart").read(), f"{folder}/bi/sales_mart")
    assert any("zstd" in n for n in os.listdir(path))
    report = bi_report(spark.read.parquet(path)).collect()
    assert [(r["region"], r["category"]) for r in report][0] == ("West", "Accessories")
    assert [r["revenue"] for r in report] == sorted((r["revenue"] for r in report), reverse=True)
    assert sum(r["orders"] for r in report) == 5


def test_quarantine(folder, lake, specs):
    put_transactions(folder, [r if r[0] != 5002 else (*r[:4], -1, *r[5:]) for r in TRANSACTIONS])
    assert run_job(lake, specs, "transactions") == 4
    assert lake.silver("transactions").row_count() == 4
    rejects = lake.rejects("transactions").collect()
    assert [(r["txn_id"], r["_failed"]) for r in rejects] == [(5002, ["positive:amount"])]
    assert rejects[0]["_load_id"]
    log = lake.loads().read().collect()
    assert [(r["table_name"], r["rows"], r["rejected"], r["cursor_value"]) for r in log] == [
        ("transactions", 4, 1, "2024-01-15T16:20:00")
    ]


def test_late_row_inside_the_lag_window(folder, lake, specs):
    run_job(lake, specs, "transactions")
    late = (5999, 1, "SKU-MOUSE", 1, 24.99, "2024-01-15", "2024-01-15T10:00:00")
    too_late = (6000, 1, "SKU-MOUSE", 1, 24.99, "2024-01-10", "2024-01-10T10:00:00")
    put_transactions(folder, [*TRANSACTIONS, late, too_late])
    assert run_job(lake, specs, "transactions") == 2  # the boundary row and the late one
    ids = {r["txn_id"] for r in lake.silver("transactions").read().collect()}
    assert ids == {5001, 5002, 5003, 5004, 5005, 5999}


def test_money_is_decimal_in_silver(lake, specs):
    run_job(lake, specs, "transactions")
    rows = lake.silver("transactions").read()
    assert rows.schema["amount"].dataType == T.DecimalType(18, 2)
    assert rows.where("txn_id = 5001").first()["amount"] == Decimal("74.97")


def test_abort_writes_nothing(tmp_path, lake):
    put(tmp_path / "q.csv", "id int, val string, updated_at string", [(1, "a", "2024-01-01T00:00:00"), (2, "b", "")])
    spec = parse_spec(
        {
            "kind": "ingest",
            "name": "q",
            "source": {"type": "csv", "path": f"{tmp_path}/q.csv", "columns": "id int, val string, updated_at string"},
            "target": {"table": "q_silver", "primary_key": "id"},
            "quality": {"not_null": ["updated_at"], "on_fail": "abort"},
        }
    )
    with pytest.raises(QualityError, match="not_null:updated_at=1"):
        run_ingest(lake, spec)
    assert lake.silver("q_silver").row_count() == 0 and not lake.silver("q_silver").exists()


EVENTS = "id int, val string, is_deleted int, updated_at string"


def events_spec(tmp_path, **target):
    return parse_spec(
        {
            "kind": "ingest",
            "name": "events",
            "source": {"type": "csv", "path": f"{tmp_path}/events.csv", "columns": EVENTS},
            "target": {
                "table": "events_cdc", "primary_key": "id", "soft_delete_column": "is_deleted", "buckets": 2, **target
            },
            "extract": {"incremental_cursor": "updated_at"},
        }
    )


def ids(lake):
    return sorted(r["id"] for r in lake.silver("events_cdc").read().collect())


@pytest.mark.parametrize("mode", ["merge", "append", "overwrite"])
def test_soft_delete(tmp_path, lake, mode):
    spec = events_spec(tmp_path, write_mode=mode)
    put(tmp_path / "events.csv", EVENTS, [(1, "a", 0, "2024-01-01T00:00:00"), (2, "b", 0, "2024-01-02T00:00:00")])
    assert run_ingest(lake, spec) == 2 and ids(lake) == [1, 2]
    rows = [(1, "a", 0, "2024-01-01T00:00:00"), (2, "b", 1, "2024-02-01T00:00:00"), (3, "c", "", "2024-02-01T00:00:00")]
    put(tmp_path / "events.csv", EVENTS, rows)
    assert run_ingest(lake, spec) == 1
    assert ids(lake) == ([3] if mode == "overwrite" else [1, 3])


def test_first_load_with_deletes(tmp_path, lake):
    put(tmp_path / "events.csv", EVENTS, [(1, "a", 0, "2024-01-01T00:00:00"), (2, "b", 1, "2024-01-02T00:00:00")])
    assert run_ingest(lake, events_spec(tmp_path)) == 1
    assert ids(lake) == [1]


def test_empty_source(tmp_path, lake):
    put(tmp_path / "events.csv", EVENTS, [])
    assert run_ingest(lake, events_spec(tmp_path)) == 0
    assert lake.silver("events_cdc").row_count() == 0


def test_repeated_keys_in_a_load_keep_the_newest(tmp_path, lake):
    put(tmp_path / "events.csv", EVENTS, [(1, "old", 0, "2024-01-01T00:00:00"), (1, "new", 0, "2024-01-03T00:00:00")])
    run_ingest(lake, events_spec(tmp_path))
    assert [(r["id"], r["val"]) for r in lake.silver("events_cdc").read().collect()] == [(1, "new")]


def test_repeated_keys_are_quarantined(tmp_path, lake):
    rows = [(1, "a", 0, "2024-01-01T00:00:00"), (2, "b", 0, "2024-01-02T00:00:00"), (2, "c", 0, "2024-01-03T00:00:00")]
    put(tmp_path / "events.csv", EVENTS, rows)
    spec = replace(events_spec(tmp_path), quality=Rules(on_fail="quarantine"))
    assert run_ingest(lake, spec) == 1 and ids(lake) == [1]
    assert sorted((r["id"], r["val"]) for r in lake.rejects("events_cdc").collect()) == [(2, "b"), (2, "c")]
    # Known keys that repeat in a later batch are rejected too, and the table keeps its rows.
    put(tmp_path / "events.csv", EVENTS, [(1, "x", 0, "2024-02-01T00:00:00"), (1, "y", 0, "2024-02-01T00:00:00")])
    assert run_ingest(lake, spec) == 0
    assert [r["val"] for r in lake.silver("events_cdc").read().collect()] == ["a"]
    assert lake.rejects("events_cdc").count() == 4


def test_upper_case_cursor(tmp_path, lake):
    columns = "ENTRY_ID int, ACCOUNT string, DEPARTMENT string, AMOUNT double, `Last Modified` string"
    header = ["ENTRY_ID", "ACCOUNT", "DEPARTMENT", "AMOUNT", "Last Modified"]
    rows = [
        (9001, "4000-Revenue", "Sales   ", 12500.00, "2024-01-05T00:00:00"),
        (9002, "5000-COGS", "Operations", -4200.50, "2024-01-06T00:00:00"),
        (9003, "6000-Marketing", "Marketing ", -1800.00, "2024-01-09T00:00:00"),
        (9004, "4000-Revenue", "Sales", 9800.00, "2024-01-12T00:00:00"),
    ]
    put_csv(tmp_path / "gl.csv", header, rows)
    spec = parse_spec(
        {
            "kind": "ingest",
            "name": "gl",
            "source": {"type": "csv", "path": f"{tmp_path}/gl.csv", "columns": columns},
            "extract": {"incremental_cursor": "Last Modified"},
            "target": {"table": "gl", "primary_key": "entry_id", "buckets": 2},
            "transforms": ["normalize_columns", "trim_strings", "add_ingested_at"],
        }
    )
    assert run_ingest(lake, spec) == 4
    table = lake.silver("gl").read()
    assert table.columns[:5] == ["entry_id", "account", "department", "amount", "last_modified"]
    assert table.where("entry_id = 9001").first()["department"] == "Sales"
    assert run_ingest(lake, spec) == 1  # the boundary row
    assert lake.silver("gl").row_count() == 4


def test_a_load_that_fails_changes_nothing(tmp_path, lake, monkeypatch):
    from tidemark.sinks import tables

    put(tmp_path / "events.csv", EVENTS, [(1, "a", 0, "2024-01-01T00:00:00")])
    spec = events_spec(tmp_path)
    run_ingest(lake, spec)
    broken = tables.change_parts

    def fail(*args, **kwargs):
        stay, fresh = broken(*args, **kwargs)
        return stay, fresh.withColumn("val", F.raise_error(F.lit("lost")).cast("string"))

    monkeypatch.setattr(tables, "change_parts", fail)
    put(tmp_path / "events.csv", EVENTS, [(1, "b", 0, "2024-01-02T00:00:00")])
    with pytest.raises(Exception, match="lost"):
        run_ingest(lake, spec)
    assert lake.silver("events_cdc").read().first()["val"] == "a"
    assert lake.loads().read().count() == 1


def test_specs_from_yaml(tmp_path):
    (tmp_path / "a.yaml").write_text(
        "kind: ingest\nname: a\nsource: {type: csv, path: x}\ntarget: {table: a, primary_key: id}\n"
    )
    (tmp_path / "b.yaml").write_text("kind: model\nname: b\ninputs: [a]\nsql: SELECT 1 AS x\ntarget: {table: b}\n")
    specs = load_specs(tmp_path)
    assert [s.name for s in specs.ingests()] == ["a"] and [s.name for s in specs.models()] == ["b"]
    assert specs["a"].write_mode == "merge" and specs["a"].lag_seconds == 0 and specs["a"].cursor is None
    (tmp_path / "c.yaml").write_text("kind: model\nname: b\ninputs: [a]\nsql: SELECT 1\ntarget: {table: b}\n")
    with pytest.raises(ValueError, match="two jobs"):
        load_specs(tmp_path)
    (tmp_path / "c.yaml").write_text("kind: report\nname: c\n")
    with pytest.raises(ValueError, match="unknown kind"):
        load_specs(tmp_path)


def test_the_specs_in_the_readme_are_valid():
    import re
    from pathlib import Path

    import yaml

    text = (Path(__file__).parent.parent / "README.md").read_text()
    found = [parse_spec(yaml.safe_load(block)) for block in re.findall(r"```yaml\n(.*?)```", text, re.S)]
    assert [s.name for s in found] == ["invoices", "sales_by_day"]
    assert found[0].quality.on_fail == "quarantine" and found[0].bucket_width == 1_000_000


def test_incomplete_specs():
    with pytest.raises(KeyError, match="primary_key"):
        parse_spec({"kind": "ingest", "name": "a", "source": {}, "target": {"table": "a"}})
    with pytest.raises(ValueError):
        parse_spec(
            {"kind": "ingest", "name": "a", "source": {}, "target": {"table": "a", "primary_key": "i", "write_mode": "x"}}
        )
    with pytest.raises(ValueError):
        parse_spec(
            {
                "kind": "ingest",
                "name": "a",
                "source": {},
                "target": {"table": "a", "primary_key": "i"},
                "quality": {"on_fail": "shrug"},
            }
        )


def test_queries_can_only_read(spark, tmp_path):
    views = {"t": spark.range(3)}
    assert query(spark, "WITH a AS (SELECT * FROM t) SELECT id FROM a ORDER BY id DESC -- done", views).count() == 3
    for sql in ("DROP VIEW t", f"INSERT OVERWRITE DIRECTORY '{tmp_path}/x' USING parquet SELECT * FROM t"):
        with pytest.raises(Exception, match="PARSE|Syntax"):
            query(spark, sql)
    assert query(spark, "SELECT count(*) AS n FROM t;", views).first()["n"] == 3


# -- the orders loads -----------------------------------------------------------------------------

SEED = [
    (1001, "2024-01-05", "C017", "Wireless Mouse", "Accessories", "North", 3, 24.99, "2024-01-05T09:00:00"),
    (1002, "2024-01-06", "C042", "Mechanical Keyboard", "Accessories", "West", 1, 89.50, "2024-01-06T10:30:00"),
    (1003, "2024-01-08", "C019", "27-inch Monitor", "Displays", "North", 2, 219.00, "2024-01-08T14:15:00"),
]
NEW = [
    (1004, "2024-01-11", "C007", "USB-C Hub", "Accessories", "South", 5, 39.95, "2024-01-11T08:45:00"),
    (1005, "2024-01-15", "C042", "Laptop Stand", "Accessories", "West", 2, 45.00, "2024-01-15T16:20:00"),
]
LATER = [
    (1006, "2024-01-18", "C033", "34-inch Ultrawide", "Displays", "East", 1, 499.99),
    (1007, "2024-01-21", "C051", "Webcam 1080p", "Peripherals", "South", 4, 62.75),
    (1008, "2024-01-24", "C007", "Noise-Cancelling Headset", "Peripherals", "South", 1, 129.00),
    (1009, "2024-01-28", "C060", "Docking Station", "Accessories", "East", 2, 159.99),
    (1010, "2024-01-30", "C019", "4K Monitor", "Displays", "North", 1, 389.00),
]


def put_orders(path, rows):
    put(path, orders_load.INCREMENTAL_SCHEMA, rows)


def test_four_incremental_runs(tmp_path, lake):
    path = tmp_path / "orders.csv"
    updated = [r if r[0] != 1002 else (*r[:6], 4, r[7], "2024-02-01T11:00:00") for r in SEED + NEW]
    assert orders_load.current_watermark(lake) == "2000-01-01T00:00:00"
    seen = []
    for rows in (SEED, SEED, SEED + NEW, updated):
        put_orders(path, rows)
        read = orders_load.run_incremental(lake, str(path))
        seen.append((read, orders_load.orders_table(lake).row_count(), orders_load.current_watermark(lake)))
    assert seen == [
        (3, 3, "2024-01-08T14:15:00"),
        (1, 3, "2024-01-08T14:15:00"),
        (3, 5, "2024-01-15T16:20:00"),
        (2, 5, "2024-02-01T11:00:00"),
    ]
    row = orders_load.order_snapshot(lake, 1002).collect()
    assert [(r["quantity"], r["revenue"], r["updated_at"]) for r in row] == [(4, 358.0, "2024-02-01T11:00:00")]
    history = lake.loads().read().collect()
    assert [r["rows"] for r in history] == [3, 2, 1]  # the run without changes left no entry
    stored = orders_load.orders_table(lake).read().orderBy("order_id").collect()
    loads = [r["load_id"] for r in history]
    assert [loads.index(r["_load_id"]) for r in stored] == [0, 2, 0, 1, 1]
    assert len({r["_row_id"] for r in stored}) == 5


def test_incremental_gate_stops_a_bad_batch(tmp_path, lake):
    path = tmp_path / "orders.csv"
    put_orders(path, [*SEED, (1004, "2024-01-11", "C007", "Hub", "Accessories", "South", -5, 1.0, "2024-01-11T08:45:00")])
    with pytest.raises(QualityError, match="Non-positive quantity"):
        orders_load.run_incremental(lake, str(path))
    assert orders_load.orders_table(lake).row_count() == 0


def test_batch_load_and_reports(spark, tmp_path):
    rows = [r[:8] for r in SEED + NEW] + LATER
    put(tmp_path / "orders.csv", orders_load.ORDERS_SCHEMA, rows)
    destination = {"type": "filesystem", "path": str(tmp_path / "out")}
    paths = orders_load.run_batch(spark, str(tmp_path / "orders.csv"), destination, str(tmp_path / "csv"), "r_")
    assert [os.path.basename(p) for p in paths] == ["r_summary_statistics", "r_revenue_by_category", "r_revenue_by_region"]
    read = lambda p: [tuple(r.values()) for r in map(lambda r: r.asDict(), spark.read.option("header", True).csv(p).collect())]
    assert read(paths[0]) == [("10", "22", "2481.19", "248.12", "7")]
    assert read(paths[1]) == [("Displays", "3", "1326.99"), ("Accessories", "5", "774.20"), ("Peripherals", "2", "380.00")]
    assert read(paths[2]) == [
        ("North", "3", "901.97"),
        ("East", "2", "819.97"),
        ("South", "3", "579.75"),
        ("West", "2", "179.50"),
    ]


def test_mart_sql_is_a_plain_query(spark):
    inputs = {
        "customers": spark.createDataFrame(CUSTOMERS, CUSTOMER_COLUMNS),
        "transactions": spark.createDataFrame(TRANSACTIONS, TRANSACTION_COLUMNS),
        "products": spark.createDataFrame(PRODUCTS, PRODUCT_COLUMNS),
    }
    assert query(spark, SALES_MART_SQL, inputs).count() == 5


@pytest.mark.parametrize("on_fail", ["abort", "quarantine", None])
def test_amounts_and_lines_that_cannot_be_stored(spark, tmp_path, on_fail):
    (tmp_path / "m.csv").write_text("id,amount\n1,2.50\n2,1e17\n3\n4,7.25\n")
    source = {"type": "csv", "path": f"{tmp_path}/m.csv", "columns": "id int, amount double"}
    rules = Rules(on_fail=on_fail) if on_fail else None
    job = Ingest(name="m", source=source, table="m", primary_key="id", money_columns=("amount",), quality=rules)
    lake = Lake(spark, str(tmp_path / "lake"))
    if on_fail != "quarantine":
        with pytest.raises(QualityError, match="money"):
            run_ingest(lake, job)
        assert not lake.silver("m").exists()
        return
    assert run_ingest(lake, job) == 2
    assert sorted(r["id"] for r in lake.silver("m").read().collect()) == [1, 4]
    rejects = {r["id"]: r["_failed"] for r in spark.read.parquet(lake.rejects_path("m")).collect()}
    assert rejects == {2: ["money:amount"], 3: ["malformed"]}


def test_named_frames_hold_for_one_query(spark):
    one, two = spark.range(1), spark.range(2)
    first, second = query(spark, "SELECT * FROM t", {"t": one}), query(spark, "WITH s AS (SELECT * FROM t) SELECT * FROM s", {"t": two})
    assert (first.count(), second.count()) == (1, 2)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        query(spark, "SELECT * FROM t")
