"""Catalog tables bucketed by their key, for upserts that shuffle no row of the table.

The table and the keys of a batch are bucketed alike, so each task joins one bucket of both. The result is
written as the next table, which then takes the name: readers see the old table or the new one. This rewrites
the table; ``Table`` rewrites the touched buckets only, and is the better choice for small batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.merge import conform, key_list, without_keys
from tidemark.sinks.files import Files


class BucketedTable:
    def __init__(self, spark: SparkSession, name: str, key: str | list[str], buckets: int, path: str):
        self.spark, self.name, self.key, self.buckets = spark, name, key_list(key), buckets
        self.path = path.rstrip("/")

    def _save(self, df: DataFrame, name: str, settled: DataFrame | None = None) -> str:
        """Write a bucketed table; ``settled`` lies in the tasks of its buckets already. Returns its folder."""
        folder = f"{self.path}/{uuid.uuid4().hex}"
        rows = df.repartition(self.buckets, *self.key)
        rows = rows if settled is None else settled.unionByName(rows)
        writer = rows.write.bucketBy(self.buckets, *self.key).sortBy(*self.key)
        writer.option("path", folder).mode("error").saveAsTable(name)
        return folder

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def create(self, df: DataFrame) -> None:
        self._save(df, self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def staying(self, keys: str) -> DataFrame:
        """Rows whose key isn't in the bucketed table ``keys``; both are read bucket by bucket."""
        return self.read().join(self.spark.table(keys).hint("merge"), self.key, "left_anti")

    def upsert(self, batch: DataFrame, dead: DataFrame | None = None) -> None:
        """Replace the rows of the batch's keys and drop those of ``dead``. The batch has unique keys and reads
        the same each time.
        """
        if not self.exists():
            self.create(batch if dead is None else without_keys(batch, dead, self.key))
            return
        fresh, keys = conform(batch, self.read().schema), batch.select(*self.key)
        if dead is not None:
            fresh, keys = without_keys(fresh, dead, self.key), keys.unionByName(dead.select(*self.key))
        types = self.read().select(*self.key).schema
        gone, following = f"{self.name}_gone_{uuid.uuid4().hex}", f"{self.name}_next_{uuid.uuid4().hex}"
        files = Files(self.spark)
        folder = self._save(conform(keys, types), gone)
        try:
            old = self.read().inputFiles()
            self._save(fresh, following, settled=self.staying(gone))
        finally:
            self.spark.sql(f"DROP TABLE {gone}")
            files.remove(folder)
        self.spark.sql(f"DROP TABLE {self.name}")
        self.spark.sql(f"ALTER TABLE {following} RENAME TO {self.name}")
        for used in {f.rsplit("/", 1)[0] for f in old}:
            files.remove(used)
