"""V1 pre-load gate and V3 reconciliation."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.constants import AUDIT_COLUMNS
from tidewater.functions.content import content_metrics, content_text


def gate_reasons(columns: Iterable[str], hash_column: str | None,
                 required: Iterable[str] = AUDIT_COLUMNS) -> list[str]:
    """Schema half of the gate (no Spark action): exact-case name checks."""
    cols = set(columns)
    reasons = []
    missing = sorted(set(required) - cols)
    if missing:
        reasons.append("missing audit columns: " + ",".join(missing))
    if hash_column and hash_column not in cols:
        reasons.append(f"missing hash column: {hash_column}")
    return reasons


def is_load_ready(df: DataFrame, hash_column: str | None) -> list[str]:
    """Reasons not to load; empty list means ready. The emptiness probe
    (a one-row read) only runs when the schema passes."""
    reasons = gate_reasons(df.columns, hash_column)
    if not reasons and df.isEmpty():
        reasons.append("empty")
    return reasons


GATE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("ready", T.BooleanType()),
    T.StructField("reasons", T.StringType()),
])


def load_gate(df: DataFrame, hash_column: str | None, table: str | None = None) -> DataFrame:
    """The gate as a one-row DataFrame: ``table_name, ready, reasons``.

    Emptiness is probed with ``DataFrame.isEmpty()``: an incremental take
    over a column-pruned plan that scans one partition first and more only
    if it finds no row - not one task per input split, which a lazy
    ``limit(1)`` under an aggregate would schedule on a 100 TB table.
    """
    schema_reasons = gate_reasons(df.columns, hash_column)
    empty = df.isEmpty()
    reasons = (["empty"] if empty else []) + schema_reasons
    return df.sparkSession.createDataFrame(
        [(table, not reasons, "; ".join(reasons))], GATE_SCHEMA)


def reconcile(*counts: int | None) -> bool | None:
    """True when every known count agrees; None when nothing was counted.
    Counts are, in order: source, landed-in, landed, loaded (any may be None)."""
    known = [n for n in counts if n is not None]
    if not known:
        return None
    return all(n == known[0] for n in known)


@dataclass(frozen=True)
class Content:
    """Row count and order-free checksum of ``columns``."""

    columns: tuple[str, ...]
    rows: int
    checksum: str


def content_of(df: DataFrame, columns: Iterable[str] | None = None) -> Content:
    """The content of ``columns`` (default: all) by one aggregate over ``df``, of which
    one row reaches the driver."""
    names = tuple(sorted(df.columns if columns is None else columns))
    row = df.agg(F.count(F.lit(1)).alias("rows"), *content_metrics(df.schema, names)).first()
    return Content(names, row["rows"], content_text(row))


def content_matches(left: DataFrame | Content, right: DataFrame,
                    columns: Iterable[str] | None = None) -> bool:
    """V3 by content: both hold the same rows the same number of times, in any order.

    Compares row counts and order-free checksums of ``columns`` (default: those of
    ``left``). A side that is compared more than once is given as its :func:`content_of`.
    """
    if not isinstance(left, Content):
        left = content_of(left, columns)
    return left == content_of(right, left.columns if columns is None else columns)
