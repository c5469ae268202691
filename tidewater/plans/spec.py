"""What to load and where: plain frozen dataclasses, no I/O."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidewater.constants import BATCH_ID, DEFAULT_HASH_BITS, MIN_PLAUSIBLE_YEAR
from tidewater.operators.audit import new_batch_id
from tidewater.sinks.modes import validate_mode


@dataclass(frozen=True)
class Source:
    """``kind``: ``jdbc`` (``name`` is a table, or a query with
    ``is_query``), ``path`` (files), ``table`` (catalog) or ``query`` (a
    connector query read with ``format``)."""
    kind: str
    name: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    is_query: bool = False
    hint: str | None = None
    partitioning: object | None = None  # sources.jdbc.JdbcPartitioning
    # JDBC: split the read into ``partitions`` even slices of this numeric, date
    # or timestamp column, between its real bounds (one extra query).
    partition_column: str | None = None
    partitions: int = 0
    # "even": slices of equal width; "depth": of about equally many rows, cut at the
    # quantiles of the column (``split_sample``: dialect text that samples the table).
    split: str = "even"
    split_sample: str | None = None
    predicates: tuple[str, ...] = ()  # JDBC: one task per WHERE clause

    def __post_init__(self):
        if sum(map(bool, (self.partitioning, self.partition_column, self.predicates))) > 1:
            raise ValueError("give one of partitioning, partition_column and predicates")
        if self.partition_column and self.partitions < 1:
            raise ValueError("partition_column needs partitions")
        if self.split not in ("even", "depth"):
            raise ValueError("split must be 'even' or 'depth'")

    def load(self, spark: SparkSession) -> DataFrame:
        if self.kind == "path":
            return spark.read.format(self.format).options(**dict(self.options)).load(self.name)
        if self.kind == "table":
            return spark.table(self.name)
        if self.kind == "jdbc":
            from tidewater.sources.jdbc import (
                full_table_query, partitioning_for, predicates_for, read_jdbc, subquery,
            )
            opts = {k: v for k, v in self.options.items() if k != "url"}
            q = self.name if self.is_query else full_table_query(self.name, self.hint)
            part, predicates = self.partitioning, self.predicates or None
            if self.partition_column and self.split == "depth":
                table = subquery(self.name) if self.is_query else self.name
                predicates = predicates_for(
                    spark, self.options["url"], table, self.partition_column, self.partitions,
                    opts, None if self.is_query else self.hint, self.split_sample)
            elif part is None and self.partition_column:
                table = subquery(self.name) if self.is_query else self.name
                part = partitioning_for(spark, self.options["url"], table, self.partition_column,
                                        self.partitions, opts,
                                        None if self.is_query else self.hint)
            return read_jdbc(spark, self.options["url"], query=q, options=opts,
                             partitioning=part, predicates=predicates)
        if self.kind == "query":
            from tidewater.sources.connector import read_query
            return read_query(spark, self.format, self.options, self.name)
        raise ValueError(f"unknown source kind {self.kind!r}")

    def count_rows(self, spark: SparkSession) -> int:
        """S3: the database counts JDBC tables; other sources count in Spark
        (parquet answers from file footers)."""
        if self.kind == "jdbc" and not self.is_query:
            from tidewater.sources.jdbc import count_query, read_jdbc
            opts = {k: v for k, v in self.options.items() if k != "url"}
            row = read_jdbc(spark, self.options["url"],
                            query=count_query(self.name, self.hint), options=opts).first()
            return int(row[0])
        return self.load(spark).count()


@dataclass(frozen=True)
class Target:
    """Load target; see ``tidewater.sinks.table`` for the kinds."""
    kind: str
    name: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    default_database: str | None = None
    default_schema: str | None = None
    partition_by: tuple[str, ...] = (BATCH_ID,)
    truncate_options: Mapping[str, str] = field(default_factory=lambda: {"truncate": "true"})
    # JDBC targets: delete the batch's rows before an incremental append, so a
    # re-run of the batch replaces it (file and catalog targets always do).
    replace_batch: bool = False
    # Path targets: with a manifest, so that every load is published in one step and
    # columns may be renamed and widened; read with ``read_lake``.
    versioned: bool = False


@dataclass(frozen=True)
class TableSpec:
    """One table: read ``source``, hash into ``hash_column``, land at
    ``lake_path``, then load ``target`` (optional)."""
    name: str
    source: Source
    hash_column: str | None
    lake_path: str
    target: Target | None = None
    lake_format: str = "parquet"
    lake_options: Mapping[str, str] = field(default_factory=dict)
    exclude: tuple[str, ...] = ()
    # Spread a source that arrives in fewer partitions than this before the
    # row-hash work, round-robin. Needs a source that answers a re-read with the
    # same rows: if it changed in between, a retried task gets other slices.
    # 0: never. Prefer a partitioned read of the source.
    spread: int = 0
    # Columns of the source that got another name: old name -> new name, as they are
    # called after the rename step. The lake's column keeps its history.
    renames: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class RunConfig:
    """Per-run settings. ``created_by`` and ``source_system`` are the values
    stamped into ``CREATED_BY`` and ``EDW_EXTERNAL_SOURCE_SYSTEM``."""
    mode: str
    created_by: str
    source_system: str
    batch_id: str = field(default_factory=new_batch_id)
    run_ts: dt.datetime | str | None = None
    as_of: dt.datetime | str | None = None
    bits: int = DEFAULT_HASH_BITS
    include_ntz: bool = False
    null_safe: bool = False
    count_source: bool = False  # S3: also count at the source and reconcile it
    future: str = "null"  # D4: "keep" leaves timestamps after as_of alone
    min_year: int = MIN_PLAUSIBLE_YEAR
    max_in_flight: int = 3  # tables loaded at a time
    time_zone: str = "UTC"  # the session must be in it, see check_zone
    # V3: "counts" compares row counts; "content" also order-free checksums of all rows
    # (one more reading of the landed batch and one of the loaded one).
    verify: str = "counts"
    # Hash maps by their sorted entries and zeros and NaNs in one form, see ``prepare``.
    canonical: bool = False
    # O2: a folder that remembers which tables of which batch are loaded and
    # reconciled; a run that is started again skips them, see ``tidewater.plans.ledger``.
    ledger: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "mode", validate_mode(self.mode))
        if self.future not in ("null", "keep"):
            raise ValueError("future must be 'null' or 'keep'")
        if self.verify not in ("counts", "content"):
            raise ValueError("verify must be 'counts' or 'content'")
