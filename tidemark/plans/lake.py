"""Where the tables of a lake lie."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.specs import Ingest
from tidemark.sinks.audit import LoadLog
from tidemark.sinks.tables import Table


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def silver(self, name: str) -> Table:
        return Table(self.spark, f"{self.root}/silver/{name}")

    def silver_of(self, spec: Ingest) -> Table:
        """The table of a spec, with the layout it gets when it is first written."""
        path = f"{self.root}/silver/{spec.table}"
        return Table(self.spark, path, spec.primary_key, spec.buckets, spec.bucket_width)

    def gold(self, name: str) -> Table:
        return Table(self.spark, f"{self.root}/gold/{name}")

    def rejects_path(self, name: str) -> str:
        return f"{self.root}/silver/{name}__rejects"

    def rejects(self, name: str) -> DataFrame:
        """Rejected rows of all loads, with the rules they broke and the load that found them."""
        return self.spark.read.option("mergeSchema", True).parquet(self.rejects_path(name))

    def loads(self) -> LoadLog:
        return LoadLog(self.spark, f"{self.root}/_loads")
