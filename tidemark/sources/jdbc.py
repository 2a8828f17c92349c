"""Database tables over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime
from urllib.parse import parse_qs, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import field_type

# Scheme of a connection string -> JDBC subprotocol and driver class.
DRIVERS = {
    "postgres": ("postgresql", "org.postgresql.Driver"),
    "postgresql": ("postgresql", "org.postgresql.Driver"),
    "mysql": ("mysql", "com.mysql.cj.jdbc.Driver"),
    "oracle": ("oracle:thin", "oracle.jdbc.OracleDriver"),
    "sqlite": ("sqlite", "org.sqlite.JDBC"),
}

FETCH_SIZE = 10_000

# Parallel connections when a spec names none: what a database bears, not what the cluster could use.
CONNECTIONS = 16


def jdbc_options(dsn: str) -> dict[str, str]:
    """Reader options for a connection string such as ``mysql+pymysql://user:pw@host:3306/db``.

    A string that starts with ``jdbc:`` is used as it is.
    """
    if dsn.startswith("jdbc:"):
        return {"url": dsn}
    parts = urlsplit(dsn)
    scheme = parts.scheme.split("+", 1)[0]
    if scheme not in DRIVERS:
        raise ValueError(f"no JDBC driver is known for {scheme!r}")
    protocol, driver = DRIVERS[scheme]
    if scheme == "sqlite":
        return {"url": f"jdbc:sqlite:{parts.path.removeprefix('/')}", "driver": driver}
    host = parts.hostname or "localhost"
    if parts.port:
        host = f"{host}:{parts.port}"
    query = parts.query
    if scheme == "oracle":
        service = parse_qs(query).get("service_name", [parts.path.lstrip("/")])[0]
        url = f"jdbc:{protocol}:@//{host}/{service}"
    else:
        if scheme == "mysql" and "useCursorFetch" not in query:
            # Without it the driver ignores the fetch size and holds a whole partition in memory.
            query = "&".join(q for q in (query, "useCursorFetch=true") if q)
        url = f"jdbc:{protocol}://{host}{parts.path}" + (f"?{query}" if query else "")
    options = {"url": url, "driver": driver}
    if parts.username:
        options["user"] = unquote(parts.username)
    if parts.password:
        options["password"] = unquote(parts.password)
    return options


def qualified(table: str, schema: str | None) -> str:
    return f"{schema}.{table}" if schema else table


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    *,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    bounds: tuple | None = None,
    narrow: Callable[[DataFrame], DataFrame] | None = None,
    quantiles: bool = False,
) -> DataFrame:
    """A lazy scan of a table; filters and column choices made on it run in the database.

    With a partition column the table is read by ``num_partitions`` connections, each taking one
    range. The ranges only divide the work: rows outside the bounds and nulls are read too. Bounds
    not given are asked from the database, one row. ``narrow`` is the filter that will be put on the
    rows: the ranges then divide what it leaves, not the whole table. With ``quantiles`` each range has as
    many rows as any other, also of a skewed key or of text; the database is asked for its bounds.
    """
    reader = spark.read.format("jdbc").options(**{"fetchsize": str(FETCH_SIZE), **options})
    whole = reader.option("dbtable", table)
    if not partition_column:
        return whole.load()
    if quantiles:
        ranges = quantile_predicates(spark, options, table, partition_column, num_partitions or CONNECTIONS)
        properties = {"fetchsize": str(FETCH_SIZE), **{k: v for k, v in options.items() if k != "url"}}
        return spark.read.jdbc(options["url"], table, predicates=ranges, properties=properties)
    if bounds is None:
        rows = whole.load()
        bounds = key_bounds(narrow(rows) if narrow else rows, partition_column)
    if bounds[0] is None:
        return whole.load()
    return whole.options(
        partitionColumn=partition_column,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=str(num_partitions or CONNECTIONS),
    ).load()


def key_bounds(table: DataFrame, column: str) -> tuple:
    """Lowest and highest value; Spark hands this aggregate to the database."""
    low, high = table.agg(F.min(column), F.max(column)).first()
    if isinstance(field_type(table, column), T.NumericType) and low is not None:
        return int(low), int(high) + 1
    return low, high


def quantile_predicates(spark: SparkSession, options: Mapping[str, str], table: str, column: str, parts: int) -> list[str]:
    """Conditions that divide a table into ranges of about as many rows each. Rows without a key are in the first.

    The database counts the rows and picks one key for each bound, from an index if it has one, so only
    the bounds leave it. A key that fills more than one range is one range.
    """

    def ask(query: str):
        row = spark.read.format("jdbc").options(**options).option("query", query).load().first()
        return None if row is None else row[0]

    stored = spark.read.format("jdbc").options(**options).option("dbtable", table).load().schema.names
    quote = "`" if ":mysql:" in options["url"] else '"'
    column = quote + next(name for name in stored if name.lower() == column.lower()) + quote
    known = f"FROM {table} WHERE {column} IS NOT NULL"
    rows = ask(f"SELECT COUNT(*) AS n {known}")
    bounds = []
    for at in sorted({rows * k // parts for k in range(1, parts)} - {0}):
        page = f"LIMIT 1 OFFSET {at}" if ":mysql:" in options["url"] else f"OFFSET {at} ROWS FETCH NEXT 1 ROWS ONLY"
        bound = sql_literal(ask(f"SELECT {column} AS bound {known} ORDER BY {column} {page}"))
        if bound not in bounds:
            bounds.append(bound)
    if not bounds:
        return ["1 = 1"]
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(bounds, bounds[1:])]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *between, f"{column} >= {bounds[-1]}"]


def sql_literal(value) -> str:
    """A value as text of a condition; times in the escapes that every JDBC driver translates."""
    if isinstance(value, datetime):
        return f"{{ts '{value.isoformat(sep=' ')}'}}"
    if isinstance(value, date):
        return f"{{d '{value.isoformat()}'}}"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)
