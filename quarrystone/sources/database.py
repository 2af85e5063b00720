"""Relational databases over JDBC."""

from __future__ import annotations

import datetime
import decimal
import math
import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import ref, require

# URL scheme -> (JDBC prefix, driver class)
DRIVERS = {
    "postgresql": ("jdbc:postgresql://", "org.postgresql.Driver"),
    "mysql": ("jdbc:mysql://", "com.mysql.cj.jdbc.Driver"),
    "mariadb": ("jdbc:mariadb://", "org.mariadb.jdbc.Driver"),
    "mssql": ("jdbc:sqlserver://", "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    "oracle": ("jdbc:oracle:thin:@//", "oracle.jdbc.OracleDriver"),
    "sqlite": ("jdbc:sqlite:", "org.sqlite.JDBC"),
}


def sql_literal(value) -> str:
    """A value as a SQL literal; types without an exact literal are refused."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError(f"No SQL literal for {value!r}")
        return repr(value)
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        if "\\" in value or "\x00" in value:
            # Backslash is an escape in some databases and plain text in others.
            raise ValueError("Text parameters must not hold backslashes or NUL")
        return "'" + value.replace("'", "''") + "'"
    raise ValueError(f"Cannot bind a parameter of type {type(value).__name__}")


def bind(query: str, params: Mapping | None) -> str:
    """Replace ``:name`` placeholders outside quotes and ``::`` casts by literals."""
    given = dict(params or {})
    used = set()

    def replace(match: re.Match) -> str:
        name = match.group("name")
        if name is None:
            return match.group()
        if name not in given:
            raise ValueError(f"No value for parameter :{name}")
        used.add(name)
        return sql_literal(given[name])

    bound = re.sub(r"'(?:[^']|'')*'|\"[^\"]*\"|::|:(?P<name>[A-Za-z_]\w*)", replace, query)
    if set(given) - used:
        raise ValueError(f"Unused parameter(s) {sorted(set(given) - used)}")
    return bound


def jdbc_options(connection_string: str) -> dict[str, str]:
    """Reader options for a ``jdbc:`` URL or a ``dialect://user:password@host/db`` URL."""
    if connection_string.startswith("jdbc:"):
        return {"url": connection_string}
    parts = urlsplit(connection_string)
    dialect = parts.scheme.split("+")[0]
    if dialect not in DRIVERS:
        raise ValueError(f"Unknown database {dialect!r}; choose one of {sorted(DRIVERS)} or a jdbc: URL")
    prefix, driver = DRIVERS[dialect]
    if dialect == "sqlite":
        return {"url": prefix + parts.path.removeprefix("/"), "driver": driver}
    place = (parts.hostname or "localhost") + (f":{parts.port}" if parts.port else "")
    name = parts.path.lstrip("/")
    tail = f";databaseName={name}" if dialect == "mssql" else f"/{name}"
    options = {"url": prefix + place + tail, "driver": driver}
    if parts.username:
        options["user"] = unquote(parts.username)
    if parts.password:
        options["password"] = unquote(parts.password)
    return options


def load_database(
    spark: SparkSession,
    query: str,
    connection_string: str,
    *,
    params: Mapping | None = None,
    parse_dates: Sequence[str] | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The result of a SELECT with ``:name`` parameters.

    ``partition_column`` with ``bounds`` and ``partitions`` reads in that many parallel
    range queries; without them one task reads everything, as JDBC has no other split.
    """
    text = bind(query, params).strip().rstrip(";")
    settings = jdbc_options(connection_string) | {"dbtable": f"({text}) q"} | dict(options or {})
    if partition_column is not None:
        if bounds is None or partitions is None:
            raise ValueError("partition_column needs bounds and partitions")
        settings |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    table = spark.read.format("jdbc").options(**settings).load()
    dates = set(require(table, parse_dates))
    return table.select(*[ref(c).try_cast("timestamp_ntz").alias(c) if c in dates else ref(c) for c in table.columns])
