"""Every operator as a query over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import transforms as tr
from tidemark.operators import incremental as inc
from tidemark.operators import merge, quality, reports
from tidemark.operators.orders_gate import orders_gate as gate_of_orders
from tidemark.plans import ingest, mart, orders
from tidemark.plans.catalog import create_as_select, list_columns
from tidemark.plans.lake import Lake
from tidemark.plans.model import model_frame, query
from tidemark.plans.run import run_all
from tidemark.plans.specs import Ingest, Model, Specs
from tidemark.session import broadcast_if_small, scratch_path
from tidemark.sinks.bucketed import BucketedTable
from tidemark.sinks.exports import export_csv, export_parquet
from tidemark.sinks.tables import Table
from tidemark.sources.footers import footer_facts
from tidemark.streaming.files import append_to, dedup_within, into_table, land_batch, run_available, stream_files, streaming_session
from tidemark.streaming.ledger import Entry, Ledger
from tidemark.workload import roles
from tidemark.workload.roles import events, table

Query = Callable[[SparkSession, str], DataFrame]

LAG = 86_400
MARK = datetime(1997, 1, 1)
# An amount with more decimals than cents.
NET_PRICE = "l_extendedprice * (1 - l_discount) AS revenue"
SPLIT, EARLIER = "timestamp_ntz'2024-01-20'", "timestamp_ntz'2024-01-15'"


# -- mart and reports ----------------------------------------------------------------------------


def gold_mart(spark: SparkSession, folder: str) -> DataFrame:
    inputs = {
        "transactions": roles.transactions(spark, folder),
        "customers": broadcast_if_small(roles.customers(spark, folder)),
        "products": roles.products(spark, folder),
    }
    return model_frame(spark, mart.SALES_MART, inputs)


def bi_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.bi_report(gold_mart(spark, folder))


def summary_statistics(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.expr(NET_PRICE),
        F.col("l_partkey").alias("customer_id"),
    )
    return reports.summary_statistics(rows)


def revenue_by_category(spark: SparkSession, folder: str) -> DataFrame:
    sold = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product_sku"), F.expr(NET_PRICE)
    )
    return reports.revenue_by_category(sold.join(roles.products(spark, folder), "product_sku"))


def revenue_by_region(spark: SparkSession, folder: str) -> DataFrame:
    sold = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"), (F.col("o_totalprice") * 0.907).alias("revenue")
    )
    return reports.revenue_by_region(sold.join(broadcast_if_small(roles.customers(spark, folder)), "customer_id"))


def top_orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = query(spark, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders", {"orders": table(spark, folder, "orders")})
    return reports.top_rows(rows, "o_totalprice", 5, "o_orderkey")


# -- incremental reads ---------------------------------------------------------------------------


def watermark(spark: SparkSession, folder: str) -> datetime:
    """The mark of a target that holds the events before the split."""
    return inc.max_cursor(events(spark, folder).where(f"ts < {SPLIT}"), "ts")


def max_cursor(spark: SparkSession, folder: str) -> DataFrame:
    return inc.max_cursor_frame(events(spark, folder), "ts")


def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).agg(F.count(F.lit(1)).alias("row_count"))


def incremental_scan(spark: SparkSession, folder: str) -> DataFrame:
    return inc.since(events(spark, folder), "ts", watermark(spark, folder))


def watermark_lag(spark: SparkSession, folder: str) -> DataFrame:
    return inc.since(events(spark, folder), "ts", inc.apply_lag(watermark(spark, folder), LAG))


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    return inc.late_rows(events(spark, folder), "ts", watermark(spark, folder), LAG)


def incremental_orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("order_date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_shipdate").alias("updated_at"),
    )
    return orders.incremental_orders(rows, MARK)


# -- upsert and delete ---------------------------------------------------------------------------


def upsert_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = events(spark, folder)
    changed = rows.where(f"ts >= {EARLIER}").withColumn("value", F.col("value") + 1)
    return rows.where(f"ts < {SPLIT}"), changed


def upsert(spark: SparkSession, folder: str) -> DataFrame:
    return merge.upsert(*upsert_sides(spark, folder), "event_id")


def upsert_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    target, batch = upsert_sides(spark, folder)
    return merge.upsert(merge.upsert(target, batch, "event_id"), batch, "event_id")


def latest_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """The newest event of every user: a batch with repeated keys made fit for an upsert."""
    return merge.latest_by_key(events(spark, folder), "user_id", "ts")


def soft_delete(spark: SparkSession, folder: str) -> DataFrame:
    rows = events(spark, folder)
    flagged = rows.withColumn("is_deleted", F.col("event_type") == "error")
    _, dead = ingest.split_deletes(flagged, "is_deleted")
    return merge.without_keys(rows, dead, "event_id")


def order_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").where(F.col("o_orderkey") == 42)


EVENTS_SPEC = Ingest(
    name="events",
    source={},
    table="events",
    primary_key="event_id",
    cursor="ts",
    lag_seconds=LAG,
    soft_delete_column="is_deleted",
    quality=quality.Rules(positive=("value",), on_fail="quarantine"),
)


def ingest_cycle(spark: SparkSession, folder: str) -> DataFrame:
    rows = events(spark, folder).withColumn("is_deleted", F.col("event_type") == "error")
    mark = watermark(spark, folder)
    target = rows.where(F.col("ts") <= inc.literal(mark, rows.schema["ts"].dataType))
    changed = inc.since(rows, "ts", inc.apply_lag(mark, LAG)).withColumn("value", F.col("value") + 1)
    return ingest.cycle(target, changed, EVENTS_SPEC).drop("is_deleted")


# -- transforms ----------------------------------------------------------------------------------


def normalize_columns(spark: SparkSession, folder: str) -> DataFrame:
    messy = table(spark, folder, "customer").toDF(" Cust Key", "NAME ", "Nation Key", "Acct Bal", " Mkt Segment ")
    return tr.normalize_columns(messy)


def trim_strings(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    padded = rows.withColumns(
        {
            "text": F.concat(F.lit(" \t\n"), F.col("text"), F.lit("\r\n  ")),
            "lang": F.concat(F.lit(" "), F.col("lang"), F.lit("　\t")),
        }
    )
    return tr.trim_strings(padded)


def add_ingested_at(spark: SparkSession, folder: str) -> DataFrame:
    at = datetime(2024, 2, 1, tzinfo=timezone.utc)
    return tr.add_ingested_at(table(spark, folder, "customer"), at)


def derive_line_totals(spark: SparkSession, folder: str) -> DataFrame:
    return tr.derive_line_totals(
        table(spark, folder, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_extendedprice").alias("amount"),
            F.col("l_quantity").alias("quantity"),
        )
    )


def typed_orders(spark: SparkSession, folder: str) -> DataFrame:
    return orders.typed_orders(
        table(spark, folder, "lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_shipdate").alias("order_date"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price"),
        )
    )


def cast_money(spark: SparkSession, folder: str) -> DataFrame:
    return tr.cast_money(table(spark, folder, "supplier"), ["s_acctbal", "no_such_column"])


def mask_pii(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    return tr.mask_pii(rows, "text", "@[A-Za-z0-9.-]+")


def add_lineage(spark: SparkSession, folder: str) -> DataFrame:
    rows = tr.cast_money(table(spark, folder, "customer"), ["c_acctbal"])
    return tr.add_lineage(rows, "load-1")


# -- quality gate --------------------------------------------------------------------------------


def typed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events whose type is missing where it was an error."""
    return events(spark, folder).withColumn("event_type", F.expr("nullif(event_type, 'error')"))


def bad(df: DataFrame, rules: dict, primary_key: str | None = None) -> DataFrame:
    return quality.bad_rows(quality.flag_rows(df, rules, primary_key)).drop(quality.FAILED)


def quality_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return bad(typed_events(spark, folder), {"not_null": ["event_type"]})


def quality_missing_column(spark: SparkSession, folder: str) -> DataFrame:
    """A column that isn't there is missing in every row."""
    return bad(table(spark, folder, "customer"), {"not_null": ["no_such_column", "c_name"]})


def quality_unique(spark: SparkSession, folder: str) -> DataFrame:
    gate = quality.inspect(table(spark, folder, "documents"), {"unique": ["text"], "on_fail": "quarantine"}, "doc_id")
    return quality.bad_rows(gate.flagged()).drop(quality.FAILED)


def quality_positive(spark: SparkSession, folder: str) -> DataFrame:
    return bad(table(spark, folder, "customer"), {"positive": ["c_acctbal"]})


BALANCE_RULES = quality.Rules(not_null=("c_name",), positive=("c_acctbal",), on_fail="quarantine")


def quarantine_good(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.gate("customer", table(spark, folder, "customer"), BALANCE_RULES, "c_custkey").good


def gate_warns(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that only warn let every row pass."""
    rules = replace(BALANCE_RULES, on_fail="warn")
    return ingest.gate("customer", table(spark, folder, "customer"), rules, "c_custkey").good


def quarantine_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejects = ingest.gate("customer", table(spark, folder, "customer"), BALANCE_RULES, "c_custkey").rejects
    return rejects.withColumn(quality.FAILED, F.array_join(quality.FAILED, ","))


def gate_report(spark: SparkSession, folder: str) -> DataFrame:
    rules = {"not_null": ["event_type"], "unique": ["user_id"], "positive": ["value"]}
    return quality.report_frame(typed_events(spark, folder), rules, "event_id")


def orders_gate(spark: SparkSession, folder: str) -> DataFrame:
    return gate_of_orders(roles.orders(spark, folder))


# -- whole loads through files -------------------------------------------------------------------


def table_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Overwrite, then upsert and delete in one write of a table on disk."""
    target, batch = upsert_sides(spark, folder)
    stored = Table(spark, scratch_path(spark, "merge"), "event_id")
    stored.overwrite(target)
    dead = events(spark, folder).where(F.col("event_type") == "error")
    stored.merge(batch, dead)
    return stored.read()


CSV_EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string, is_deleted boolean"
)
CSV_FORMAT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "escape": '"'}


def ingest_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads from CSV: a first one, and one that starts from its high-water mark less the lag."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    load_events(spark, folder, lake)
    return lake.silver("events").read().drop("is_deleted")


def load_events(spark: SparkSession, folder: str, lake: Lake) -> None:
    error = F.col("event_type") == "error"
    rows = events(spark, folder)
    sources = {
        "first": rows.where(f"ts < {SPLIT}").withColumn("is_deleted", F.lit(False)),
        "second": rows.withColumns({"value": F.col("value") + 1, "is_deleted": error}),
    }
    for name, df in sources.items():
        path = scratch_path(spark, name)
        df.write.options(header=True, **CSV_FORMAT).csv(path)
        source = {"type": "csv", "path": path, "columns": CSV_EVENTS, "options": CSV_FORMAT}
        spec = replace(EVENTS_SPEC, source=source, transforms=("trim_strings",), money_columns=("value",))
        ingest.run_ingest(lake, spec)


def exported_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report read off the exported mart."""
    path = export_parquet(gold_mart(spark, folder), scratch_path(spark, "mart"))
    return reports.bi_report(spark.read.parquet(path))


def csv_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report read off its CSV file."""
    report = bi_report(spark, folder)
    path = export_csv({"by_region_and_category": report}, scratch_path(spark, "reports"))[0]
    return spark.read.schema(report.schema).option("header", True).csv(path)


def history(lake: Lake) -> DataFrame:
    reached = F.col("cursor_value").cast("timestamp_ntz").alias("cursor_value")  # kept as ISO text
    return lake.loads().read().select("table_name", "status", "rows", "rejected", "deleted", reached)


def load_history(spark: SparkSession, folder: str) -> DataFrame:
    """What the log says of two loads, the second of which starts from the mark of the first."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    load_events(spark, folder, lake)
    return history(lake)


REGION_SALES = Model(
    name="region_sales",
    inputs=("orders", "customers"),
    sql="""
        SELECT region, count(*) AS orders, sum(amount) AS revenue
        FROM orders JOIN customers ON orders.customer_id = customers.customer_id GROUP BY region
    """,
    table="region_sales",
    money_columns=("revenue",),
)


def run_all_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Two ingests side by side, then a model over both; the gold table."""
    lake, specs = Lake(spark, scratch_path(spark, "lake")), Specs()
    sources = {
        "orders": table(spark, folder, "orders").selectExpr("o_orderkey AS order_id", "o_custkey AS customer_id", "o_totalprice AS amount"),
        "customers": roles.customers(spark, folder),
    }
    for name, df in sources.items():
        path = scratch_path(spark, name)
        df.write.option("header", True).csv(path)
        columns = ", ".join(f"{c} {kind}" for c, kind in df.dtypes)
        money = ("amount",) if "amount" in df.columns else ()
        source = {"type": "csv", "path": path, "columns": columns}
        specs.add(Ingest(name=name, source=source, table=name, primary_key=df.columns[0], money_columns=money))
    specs.add(REGION_SALES)
    run_all(lake, specs, parallel=2)
    return lake.gold("region_sales").read()


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Two drops of files as a stream into a table; the second updates keys inside the lag window."""
    drops, home = scratch_path(spark, "drops"), scratch_path(spark, "stream")
    target, changed = upsert_sides(spark, folder)
    stored = Table(spark, f"{home}/table", "event_id")
    for drop in (target, changed):
        drop.write.mode("append").parquet(drops)
        files = stream_files(spark, drops, roles.SCHEMAS["events"])
        run_available(into_table(files, stored, "event_id", "ts", 7 * LAG, f"{home}/rejects"), f"{home}/state")
    return stored.read()


def table_append(spark: SparkSession, folder: str) -> DataFrame:
    """A table that is appended to, with a lookup by key in the end."""
    rows = events(spark, folder)
    stored = Table(spark, scratch_path(spark, "append"), "event_id")
    stored.overwrite(rows.where(f"ts < {EARLIER}"))
    stored.append(rows.where(f"ts >= {EARLIER}"))
    stored.append(stored.lookup(event_id=42))
    return stored.read()


def table_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and high-water mark of a stored table."""
    stored = Table(spark, scratch_path(spark, "facts"), "event_id")
    stored.overwrite(events(spark, folder))
    facts = [(stored.row_count(), stored.max_cursor("ts"))]
    return spark.createDataFrame(facts, "row_count bigint, max_cursor timestamp_ntz")


def csv_with_bad_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks through CSV, with lines that lack a field: good rows, and rejects by their rules."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    path, lake = scratch_path(spark, "texts"), Lake(spark, scratch_path(spark, "lake"))
    docs.write.options(header=True, escape='"', quoteAll=True).csv(path)
    short = docs.where("doc_id % 7 = 0").select((-1 - F.col("doc_id")).alias("doc_id"), F.lit("cut off").alias("text"))
    # One column of whole lines, named like the header: every file has it, from every task.
    lines = short.select(F.concat_ws(",", "doc_id", "text").alias("doc_id,text,source"))
    lines.write.mode("append").options(header=True, sep="\t").csv(path)
    source = {"type": "csv", "path": path, "columns": "doc_id bigint, text string, source string"}
    rules = quality.Rules(on_fail="quarantine")
    ingest.run_ingest(lake, Ingest(name="texts", source=source, table="texts", primary_key="doc_id", quality=rules))
    good = lake.silver("texts").read().withColumn("failed", F.lit(""))
    rejects = spark.read.parquet(lake.rejects_path("texts"))
    rejects = rejects.select("doc_id", "text", "source", F.array_join(quality.FAILED, ",").alias("failed"))
    return good.unionByName(rejects)


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Three drops as a stream that holds the keys of its window: the second repeats keys of the first, and the
    third has new keys far behind the watermark, which are left out.
    """
    drops, home = scratch_path(spark, "drops"), scratch_path(spark, "dedup")
    rows = events(spark, folder)
    late = rows.where("ts < timestamp_ntz'2024-01-05'").withColumn("event_id", -1 - F.col("event_id"))
    for drop in (rows.where(f"ts < {SPLIT}"), rows.where(f"ts >= {EARLIER}"), late):
        drop.write.mode("append").parquet(drops)
        files = stream_files(streaming_session(spark), drops, roles.SCHEMAS["events"])
        run_available(append_to(dedup_within(files, "event_id", "ts", 7 * LAG), f"{home}/rows"), f"{home}/state")
    return spark.read.parquet(f"{home}/rows")


def stream_replay(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that is cut short after the table has changed, then runs again, then once more: rejects per batch
    and the rows of the table.
    """
    home = scratch_path(spark, "replay")
    stored, ledger = Table(spark, f"{home}/table", "event_id"), Ledger(spark, f"{home}/batches", "replay")
    rows = events(spark, folder)
    drops = (rows.where(f"ts < {SPLIT}"), rows.where(f"ts >= {EARLIER} OR ts < timestamp_ntz'2024-01-05'"))

    def land(batch_id: int, log: Ledger) -> None:
        land_batch(drops[batch_id], batch_id, stored, "event_id", "ts", 7 * LAG, f"{home}/rejects", log)

    land(0, ledger)
    try:
        land(1, CutShort(spark, ledger.path, ledger.query))
    except InterruptedError:
        pass
    land(1, ledger)
    land(1, ledger)
    rejects = spark.read.parquet(f"{home}/rejects").groupBy(F.col("_batch_id").cast("bigint").alias("batch"))
    counts = rejects.agg(F.count(F.lit(1)).alias("rows")).withColumn("kind", F.lit("rejects"))
    total = stored.read().agg(F.lit(None).cast("bigint").alias("batch"), F.count(F.lit(1)).alias("rows"), F.lit("table").alias("kind"))
    return counts.unionByName(total)


class CutShort(Ledger):
    """A ledger whose batches stop when the table has changed and before that is noted."""

    def entry(self, batch_id: int) -> Entry:
        class Stopped(Entry):
            def note(self, step: str, mark: str | None = None) -> None:
                if step == "done":
                    raise InterruptedError("lost before the batch was done")
                super().note(step, mark)

        return Stopped(self.spark, super().entry(batch_id).path)


def bucketed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """An upsert and deletes between catalog tables that are bucketed alike."""
    target, batch = upsert_sides(spark, folder)
    stored = BucketedTable(spark, f"events_{uuid.uuid4().hex}", "event_id", 8, scratch_path(spark, "bucketed"))
    stored.upsert(target)
    stored.upsert(batch, events(spark, folder).where(F.col("event_type") == "error"))
    return stored.read()


def soft_delete_many(spark: SparkSession, folder: str) -> DataFrame:
    """Deletes by a key set that is taken as too large to broadcast: a bitmap clears the rows that stay."""
    rows = events(spark, folder)
    dead = rows.where(F.col("event_type") == "error").select("event_id")
    return merge.without_many_keys(rows, dead, "event_id", dead.count())


def written_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that writes report of themselves, beside what the table then holds."""
    rows = events(spark, folder)
    stored = Table(spark, scratch_path(spark, "counted"), "event_id")
    first = stored.overwrite(rows.where(f"ts < {SPLIT}"))
    added = stored.append(rows.where(f"ts >= {SPLIT}"))
    return stored.read().agg(
        F.lit(first).cast("bigint").alias("first"), F.lit(added).cast("bigint").alias("added"), F.count(F.lit(1)).alias("stored")
    )


def footer_scalars(spark: SparkSession, folder: str) -> DataFrame:
    """Row count and highest key of a stored table, from footers."""
    return footer_facts(spark, f"{folder}/events.parquet", "event_id")


def describe_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of the mart as a table of the catalog, made from its query."""
    name = f"sales_mart_{uuid.uuid4().hex}"
    create_as_select(spark, name, gold_mart(spark, folder), scratch_path(spark, "catalog"))
    try:
        return list_columns(spark, name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def gate_aborts(spark: SparkSession, folder: str) -> DataFrame:
    """A load that is aborted by its gate leaves the table and its log as they were."""
    lake, people = Lake(spark, scratch_path(spark, "lake")), table(spark, folder, "customer")
    spec = Ingest(name="customer", source={}, table="customer", primary_key="c_custkey", quality=replace(BALANCE_RULES, on_fail="abort"))
    for df in (people.where("c_acctbal > 0"), people.withColumn("c_name", F.lit("changed"))):
        path = scratch_path(spark, "customer")
        df.write.option("header", True).csv(path)
        try:
            ingest.run_ingest(lake, replace(spec, source={"type": "csv", "path": path, "columns": roles.SCHEMAS["customer"]}))
        except quality.QualityError:
            pass
    return lake.silver("customer").read().withColumn("loads", F.lit(lake.loads().read().count()).cast("bigint"))


ORDER_RUNS = ("2000-07-01", "2000-07-01", "2001-02-01", "2100-01-01")


def stateful_cursor(spark: SparkSession, folder: str) -> DataFrame:
    """Four incremental loads, of a source that doesn't change before the second and grows before the third and
    the fourth: candidates read, rows stored and the cursor kept after each.
    """
    lake, runs = Lake(spark, scratch_path(spark, "lake")), []
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_orderstatus").alias("category"),
        F.lit("all").alias("region"),
        F.lit(1).cast("bigint").alias("quantity"),
        F.col("o_totalprice").alias("unit_price"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"),
    )
    for run, until in enumerate(ORDER_RUNS, 1):
        path = scratch_path(spark, "orders")
        rows.where(F.col("order_date") < until).write.option("header", True).csv(path)
        read = orders.run_incremental(lake, path)
        runs.append((run, read, orders.orders_table(lake).row_count(), orders.current_watermark(lake)))
    return spark.createDataFrame(runs, "run int, candidates bigint, stored bigint, cursor_value string")


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        gold_mart,
        bi_report,
        summary_statistics,
        revenue_by_category,
        revenue_by_region,
        top_orders,
        max_cursor,
        row_count,
        incremental_scan,
        watermark_lag,
        late_rows,
        incremental_orders,
        upsert,
        upsert_idempotent,
        latest_by_key,
        soft_delete,
        order_snapshot,
        ingest_cycle,
        normalize_columns,
        trim_strings,
        add_ingested_at,
        derive_line_totals,
        typed_orders,
        cast_money,
        mask_pii,
        add_lineage,
        quality_not_null,
        quality_missing_column,
        quality_unique,
        quality_positive,
        gate_warns,
        quarantine_good,
        quarantine_rejects,
        gate_report,
        orders_gate,
        table_merge,
        ingest_run,
        exported_report,
        csv_report,
        load_history,
        run_all_jobs,
        stream_ingest,
        table_append,
        table_facts,
        csv_with_bad_lines,
        stream_dedup,
        stream_replay,
        bucketed_upsert,
        soft_delete_many,
        written_counts,
        footer_scalars,
        describe_columns,
        gate_aborts,
        stateful_cursor,
    )
}
