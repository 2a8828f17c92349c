"""Load a frame into the destination a configuration names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame

from tidemark.operators.merge import key_list, one_row_per_key
from tidemark.session import landed
from tidemark.sinks.tables import Table, write
from tidemark.sources.extract import from_env
from tidemark.sources.jdbc import jdbc_options

# Load dispositions -> write modes.
DISPOSITIONS = {"replace": "overwrite", "append": "append", "merge": "merge"}


def load(
    df: DataFrame,
    destination: Mapping,
    table: str,
    disposition: str = "replace",
    primary_key: str | None = None,
    cursor: str | None = None,
) -> None:
    """``replace``, ``append`` or ``merge`` (by key) into a lake or a database.

    ``filesystem`` needs ``path``; a database needs ``dsn`` or ``dsn_env`` and takes extra writer
    ``options``, such as ``batchsize`` or ``numPartitions`` to bound its connections.
    """
    if disposition not in DISPOSITIONS:
        raise ValueError(f"unknown disposition {disposition!r}; use one of {', '.join(DISPOSITIONS)}")
    kind = destination.get("type", "filesystem")
    if kind == "filesystem":
        target = Table(df.sparkSession, f"{destination['path'].rstrip('/')}/{table}", key=primary_key)
        write(target, df, DISPOSITIONS[disposition], primary_key, cursor=cursor)
    elif kind in ("postgres", "mysql", "oracle", "jdbc"):
        options = jdbc_options(destination.get("dsn") or from_env(destination["dsn_env"], "connection"))
        options = {**options, **destination.get("options", {})}
        if disposition == "merge":
            if not primary_key:
                raise ValueError("a merge needs a primary key")
            with landed(df, "merge") as rows:
                merge_into_database(one_row_per_key(rows, primary_key, cursor), options, table, key_list(primary_key))
        else:
            put(df, options, table, DISPOSITIONS[disposition])
    else:
        raise ValueError(f"unsupported destination type {kind!r}")


def put(df: DataFrame, options: Mapping[str, str], table: str, mode: str) -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).mode(mode).save()


def merge_into_database(df: DataFrame, options: Mapping[str, str], table: str, key: list[str]) -> None:
    """Upsert rows with unique keys: executors fill a staging table, and one MERGE of the database does the rest.

    A table that isn't there is created. The staging table is dropped in any case.
    """
    if options["url"].startswith("jdbc:mysql"):
        raise ValueError("MySQL has no MERGE; merge into filesystem, then replace or append")
    with statement(df, options) as run:
        try:
            run(f"SELECT 1 FROM {table} WHERE 1 = 0")
        except Exception:  # every database has its own error for this
            put(df, options, table, "append")
            return
        stage = f"{table}_{uuid.uuid4().hex[:8]}"
        try:
            put(df, options, stage, "errorifexists")
            run(merge_statement(df, options["url"], table, stage, key))
        finally:
            run(f"DROP TABLE {stage}")


def merge_statement(df: DataFrame, url: str, table: str, stage: str, key: list[str]) -> str:
    dialect = df.sparkSession._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    names = {c: dialect.quoteIdentifier(c) for c in df.columns}
    keys = {k.lower() for k in key}
    same = " AND ".join(f"t.{q} = s.{q}" for c, q in names.items() if c.lower() in keys)
    rest = ", ".join(f"{q} = s.{q}" for c, q in names.items() if c.lower() not in keys)
    update = f" WHEN MATCHED THEN UPDATE SET {rest}" if rest else ""
    columns, values = ", ".join(names.values()), ", ".join(f"s.{q}" for q in names.values())
    return f"MERGE INTO {table} t USING {stage} s ON ({same}){update} WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({values})"


@contextmanager
def statement(df: DataFrame, options: Mapping[str, str]) -> Iterator:
    """A function that runs one statement on a connection of the driver's."""
    jvm = df.sparkSession._jvm
    if "driver" in options:
        jvm.java.lang.Class.forName(options["driver"])
    properties = jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in options:
            properties.setProperty(name, options[name])
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        opened = connection.createStatement()
        yield opened.execute
    finally:
        connection.close()
