"""Models: SQL over silver tables, rebuilt whole into a gold table."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.transforms import cast_money
from tidemark.plans.lake import Lake
from tidemark.plans.specs import Model

log = logging.getLogger(__name__)


def query(spark: SparkSession, sql: str, inputs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run a query over named frames. As a subquery it can only read: a statement that would write
    or define anything is a syntax error there.

    The names hold for this call only: the frames are views under names of their own, which are gone
    once the query is analysed, so queries that run side by side don't see each other's.
    """
    views = {name: f"_{uuid.uuid4().hex}" for name in inputs or {}}
    try:
        for name, view in views.items():
            inputs[name].createTempView(view)
        named = ", ".join(f"`{name}` AS (SELECT * FROM {view})" for name, view in views.items())
        return spark.sql(f"{'WITH ' if views else ''}{named} SELECT * FROM (\n{sql.strip().rstrip(';')}\n)")
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def model_frame(spark: SparkSession, spec: Model, inputs: Mapping[str, DataFrame]) -> DataFrame:
    return cast_money(query(spark, spec.sql, inputs), spec.money_columns)


def run_model(lake: Lake, spec: Model) -> int:
    """Rebuild a gold table and return its number of rows."""
    inputs = {name: lake.silver(name).read() for name in spec.inputs}
    rows = lake.gold(spec.table).overwrite(model_frame(lake.spark, spec, inputs))
    log.info("[%s] %d rows", spec.name, rows)
    return rows
