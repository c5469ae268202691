"""S1-S3: JDBC reads of a query, a full table, and a pushed-down count."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.naming import qcol

# Reader settings; callers override per source. Limit and aggregate push-down
# are documented for the JDBC catalog; format("jdbc") may ignore them, so
# emptiness and counts are asked with a query of their own.
DEFAULT_READ_OPTIONS = {"fetchsize": "50000", "pushDownLimit": "true",
                        "pushDownAggregate": "true"}


@dataclass(frozen=True)
class JdbcPartitioning:
    """Parallel JDBC read: ``num_partitions`` range slices of a numeric,
    date or timestamp column. Each slice is one task and one connection;
    bounds only shape the slices, rows outside them are still read."""
    column: str
    lower_bound: str
    upper_bound: str
    num_partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower_bound),
            "upperBound": str(self.upper_bound),
            "numPartitions": str(self.num_partitions),
        }


def subquery(query: str, alias: str = "src") -> str:
    """``(query) src``: usable as ``dbtable`` (unlike the ``query`` option,
    this combines with ``partitionColumn``)."""
    return f"({query}) {alias}"


def full_table_query(table: str, hint: str | None = None) -> str:
    """``SELECT * FROM table [hint]``; ``hint`` is dialect text such as a
    lock hint, passed through verbatim. Same query in every load mode."""
    return f"SELECT * FROM {table}" + (f" {hint}" if hint else "")


def count_query(table: str, hint: str | None = None) -> str:
    """Row count evaluated by the database: one row, ``total_count``."""
    return f"SELECT COUNT(*) AS total_count FROM {table}" + (f" {hint}" if hint else "")


def read_jdbc(spark: SparkSession, url: str, query: str | None = None,
              table: str | None = None, options: Mapping[str, str] | None = None,
              partitioning: JdbcPartitioning | None = None,
              predicates: Sequence[str] | None = None) -> DataFrame:
    """Read a query (wrapped as a sub-query) or a table over JDBC.

    ``.load()`` only fetches the schema; rows move when an action runs.
    ``partitioning`` or ``predicates`` split the read over many tasks, which
    is what keeps a large table from being read by a single task.
    """
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    dbtable = subquery(query) if query is not None else table
    opts = {**DEFAULT_READ_OPTIONS, **(options or {})}
    if predicates:
        props = {k: v for k, v in opts.items()}
        return spark.read.jdbc(url, dbtable, predicates=list(predicates), properties=props)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable)
    reader = reader.options(**opts)
    if partitioning is not None:
        reader = reader.options(**partitioning.options())
    return reader.load()


def bounds_query(table: str, column: str, hint: str | None = None) -> str:
    """``MIN``/``MAX`` of the split column, evaluated by the database."""
    return (f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
            + (f" {hint}" if hint else ""))


def partitioning_for(spark: SparkSession, url: str, table: str, column: str,
                     num_partitions: int, options: Mapping[str, str] | None = None,
                     hint: str | None = None) -> JdbcPartitioning | None:
    """Range partitioning over the column's actual bounds (one one-row query).

    Returns None for an empty table. Size ``num_partitions`` to the table,
    not the cluster: each slice is one database connection.
    """
    row = read_jdbc(spark, url, query=bounds_query(table, column, hint), options=options).first()
    if row is None or row[0] is None:
        return None
    return JdbcPartitioning(column, str(row[0]), str(row[1]), num_partitions)


def _bound(value) -> str:
    """A split bound as SQL text."""
    if isinstance(value, dt.datetime):
        return f"'{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"'{value:%Y-%m-%d}'"
    return str(value)


def equal_depth_predicates(values: DataFrame, column: str, parts: int,
                           name: str | None = None) -> list[str]:
    """``WHERE`` clauses that cut ``values`` into at most ``parts`` slices of about
    equally many rows, by ``column`` (numeric, date or timestamp).

    The cuts are quantiles from one mergeable sketch over all rows; a skewed column
    gets narrow slices where its rows are. A value that fills several slices gets one
    of its own, since the column cannot split it further. Every row, NULLs included,
    belongs to exactly one clause, whatever the cuts. ``name`` is the column's name in
    the clauses. No rows, or one value only: a single clause for everything.
    """
    kind = values.schema[column].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{column} is {kind.simpleString()}: a database may order it otherwise")
    shares = [i / parts for i in range(1, parts)]
    value = qcol(column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)
    row = values.agg(F.percentile_approx(value, shares, 100 * parts).alias("q"),
                     F.min(value).alias("lo")).first() if shares else None
    found = (row["q"] or []) if row else []
    # a value that is the quantile of several shares: cut behind it as well
    heavy = {c for c in found if found.count(c) > 1 and row["lo"] != max(found)}
    cuts = sorted({c for c in found if c != row["lo"] or c in heavy})
    name = name or column
    if not cuts:
        return [f"{name} IS NOT NULL OR {name} IS NULL"]
    out = [f"{name} < {_bound(cuts[0])} OR {name} IS NULL"]
    for i, low in enumerate(cuts):
        upper = f" AND {name} < {_bound(cuts[i + 1])}" if i + 1 < len(cuts) else ""
        if low in heavy:
            out += [f"{name} = {_bound(low)}", f"{name} > {_bound(low)}{upper}"]
        else:
            out.append(f"{name} >= {_bound(low)}{upper}")
    return out


def predicates_for(spark: SparkSession, url: str, table: str, column: str, parts: int,
                   options: Mapping[str, str] | None = None, hint: str | None = None,
                   sample: str | None = None) -> list[str] | None:
    """Equal-depth slices of a table: reads the one column, itself in even slices.

    ``sample`` is dialect text after the table's name (``TABLESAMPLE SYSTEM (1)``), so
    that the database sends a sample of it; the clauses cover all rows all the same.
    None for an empty table.
    """
    even = partitioning_for(spark, url, table, column, parts, options, hint)
    if even is None:
        return None
    source = f"{table} {sample}" if sample else table
    query = f"SELECT {column} FROM {source}" + (f" {hint}" if hint else "")
    values = read_jdbc(spark, url, query=query, options=options, partitioning=even)
    return equal_depth_predicates(values, values.columns[0], parts, column)
