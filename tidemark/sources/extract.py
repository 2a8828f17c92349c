"""Choose the reader a spec names, and read from the high-water mark on."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import has_column
from tidemark.operators.incremental import since
from tidemark.sources.csv import MALFORMED, read_csv
from tidemark.sources.jdbc import jdbc_options, qualified, read_table

DATABASES = ("postgres", "mysql", "oracle", "sqlite", "jdbc")


def from_env(name: str, what: str) -> str:
    value = os.environ.get(name)
    if not value:
        raise RuntimeError(f"{what} environment variable {name!r} is not set")
    return value


def open_source(
    spark: SparkSession,
    source: Mapping,
    narrow: Callable[[DataFrame], DataFrame] | None = None,
    mark_malformed: bool = False,
) -> DataFrame:
    """The whole source as a lazy frame; for ``narrow`` and ``mark_malformed`` see the readers."""
    kind = source["type"]
    if kind in DATABASES:
        options = jdbc_options(source.get("dsn") or from_env(source["dsn_env"], "connection"))
        return read_table(
            spark,
            {**options, **source.get("options", {})},
            qualified(source["table"], source.get("schema")),
            partition_column=source.get("partition_column"),
            num_partitions=source.get("num_partitions"),
            narrow=narrow,
            quantiles=source.get("partition_by") == "quantiles",
        )
    if kind == "csv":
        path = source.get("path") or from_env(source["path_env"], "path")
        return read_csv(spark, path, source.get("columns"), source.get("options"), mark_malformed)
    raise ValueError(f"unsupported source type {kind!r}")


def extract(
    spark: SparkSession, source: Mapping, cursor: str | None = None, watermark=None, mark_malformed: bool = False
) -> DataFrame:
    """Candidate rows: all of the source, or those at or after the mark, and malformed lines if marked."""

    def newer(rows: DataFrame) -> DataFrame:
        return since(rows, cursor, watermark)

    rows = open_source(spark, source, newer, mark_malformed)
    if cursor and source["type"] in DATABASES and not has_column(rows, cursor):
        raise ValueError(f"{source['table']} has no column {cursor!r} to read on from")
    if not has_column(rows, MALFORMED):
        return newer(rows)
    return newer(rows.where(F.col(MALFORMED).isNull())).unionByName(rows.where(F.col(MALFORMED).isNotNull()))
