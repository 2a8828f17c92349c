"""One row per load: what ran, when, how many rows, and the cursor it reached."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import one_row
from tidemark.sinks.files import Files

SCHEMA = "status string, rows bigint, rejected bigint, deleted bigint, cursor_value string, inserted_at timestamp"


class LoadLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(
        self, load_id: str, table: str, status: str, rows: int, rejected: int = 0, deleted: int = 0, cursor=None
    ) -> None:
        text = cursor.isoformat() if isinstance(cursor, (datetime, date)) else cursor
        text = None if text is None else str(text)
        now = datetime.now(timezone.utc).isoformat()
        values = (status, rows, rejected, deleted, text, now)
        columns = zip((c.split() for c in SCHEMA.split(", ")), values)
        df = one_row(self.spark, **{name: F.lit(v).cast(dtype) for (name, dtype), v in columns})
        # A folder per load: loads that run side by side must not share one output folder.
        df.write.parquet(f"{self._of(table)}/load_id={load_id}")

    def _of(self, table: str) -> str:
        return f"{self.path}/table_name={table}"

    def read(self) -> DataFrame:
        """All loads in order of time."""
        return self._scan(self.path).orderBy("inserted_at", "load_id")

    def _scan(self, folder: str) -> DataFrame:
        schema = f"{SCHEMA}, table_name string, load_id string"
        if not Files(self.spark).names(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(folder)

    def last_cursor(self, table: str, initial: str | None = None) -> str | None:
        """The cursor the latest finished load of a table reached, or the initial value."""
        done = self._scan(self._of(table)).where(F.col("status") == "loaded")
        row = done.where(F.col("cursor_value").isNotNull()).agg(F.max_by("cursor_value", "inserted_at")).first()
        return initial if row[0] is None else row[0]
