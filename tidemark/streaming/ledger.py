"""Which micro-batches of a stream are prepared and done, kept beside the data they went into."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import one_row
from tidemark.sinks.files import Files

STEPS = ("prepared", "done")


@dataclass(frozen=True)
class Entry:
    """One batch: its rows, and the steps it has reached. A step is a folder, there in full or not at all."""

    spark: SparkSession
    path: str

    def reached(self, step: str) -> bool:
        return any(n.endswith(".parquet") for n in Files(self.spark).names(f"{self.path}/{step}"))

    def note(self, step: str, mark: str | None = None) -> None:
        if step not in STEPS:
            raise ValueError(f"unknown step {step!r}")
        row = one_row(self.spark, mark=F.lit(mark).cast("string"), at=F.current_timestamp())
        row.write.mode("overwrite").parquet(f"{self.path}/{step}")

    def put(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/rows")

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def clear(self) -> None:
        """The rows are in the table; the steps stay."""
        Files(self.spark).remove(f"{self.path}/rows")


@dataclass(frozen=True)
class Ledger:
    """The batches of one query, which the stream's checkpoint numbers."""

    spark: SparkSession
    path: str
    query: str

    def entry(self, batch_id: int) -> Entry:
        return Entry(self.spark, f"{self.path}/query={self.query}/batch={batch_id}")
