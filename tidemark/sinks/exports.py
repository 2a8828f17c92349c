"""Hand-off files for other tools."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def export_parquet(df: DataFrame, path: str) -> str:
    """Parquet compressed with ZSTD."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def export_csv(reports: Mapping[str, DataFrame], folder: str, prefix: str = "") -> list[str]:
    """One CSV folder per report, with a header.

    Reports are small aggregates already in order, so each becomes a single file; the rows are
    aggregated in parallel before that, as the order needs a shuffle.
    """
    written = []
    for name, report in reports.items():
        path = f"{folder.rstrip('/')}/{prefix}{name}"
        report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        written.append(path)
    return written
