"""Tables of the warehouse catalog: made from a query, and listed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_as_select(spark: SparkSession, name: str, df: DataFrame, path: str | None = None) -> None:
    """Create or replace a catalog table from a query, in the warehouse or in a folder of its own."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def list_columns(spark: SparkSession, name: str) -> DataFrame:
    """Name and type of every column of a catalog table, in order."""
    rows = [(i, c.name, c.dataType) for i, c in enumerate(spark.catalog.listColumns(name), 1)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")
