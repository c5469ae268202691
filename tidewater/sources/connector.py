"""S4: read the result of a query through any Spark connector that takes
a ``query`` option (warehouse connectors, JDBC)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, fmt: str, options: Mapping[str, str],
               query: str) -> DataFrame:
    return spark.read.format(fmt).options(**dict(options)).option("query", query).load()
