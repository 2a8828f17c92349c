"""CSV files with a header."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

log = logging.getLogger(__name__)


# Column that holds the text of a line that doesn't fit the declared columns.
MALFORMED = "_malformed"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    mark_malformed: bool = False,
) -> DataFrame:
    """Read one file, or all files of a folder.

    Give a schema: without one the files are read an extra time to guess the types. Quoted line breaks
    are part of their value; files without any stay splittable with the option ``multiLine`` set to false.

    A line with too few or too many fields, or with a value that its column can't hold, is an error.
    With ``mark_malformed`` it becomes a row with its text in the column ``_malformed``, for the gate.
    """
    # Without enforceSchema a header that does not name the declared columns is an error, where
    # values would else be taken by position. Unread columns have to be counted as well.
    reader = spark.read.options(header=True, escape='"', enforceSchema=False, multiLine=True, columnPruning=False)
    if schema is None:
        log.warning("%s: no schema given, types are inferred by an extra pass", path)
        return reader.options(inferSchema=True, mode="FAILFAST").options(**(options or {})).csv(path)
    if not mark_malformed:
        return reader.option("mode", "FAILFAST").options(**(options or {})).schema(schema).csv(path)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = T.StructType([*fields.fields, T.StructField(MALFORMED, T.StringType())])
    return reader.option("columnNameOfCorruptRecord", MALFORMED).options(**(options or {})).schema(marked).csv(path)
