"""Readers: JDBC queries (S1-S3), connector queries (S4), lake paths (S5),
target existence (S6)."""

from tidewater.sources.jdbc import (
    JdbcPartitioning, read_jdbc, full_table_query, count_query, subquery, bounds_query,
    equal_depth_predicates, partitioning_for, predicates_for,
)
from tidewater.sources.connector import read_query
from tidewater.sources.lake import read_lake
from tidewater.sources.catalog import metadata_query, split_table_name, target_exists

__all__ = [
    "JdbcPartitioning", "read_jdbc", "full_table_query", "count_query", "subquery",
    "bounds_query", "partitioning_for", "equal_depth_predicates", "predicates_for",
    "read_query", "read_lake", "target_exists", "split_table_name", "metadata_query",
]
