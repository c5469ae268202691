"""P3: six audit columns, appended in a fixed order (or replaced in place)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.constants import (
    APPENDED_AUDIT, BATCH_ID, BATCH_ID_FORMAT, CREATED_BY, ETL_CREATED_DATE,
    ETL_LAST_UPDATE_DATE, ROW_HASH, SOURCE_SYSTEM, TO_PROCESS,
)
from tidewater.functions.timestamps import timestamp_literal


def new_batch_id(now: dt.datetime | None = None) -> str:
    """``YYYYMMDDHHMMSS`` of the driver's clock."""
    return (now or dt.datetime.now()).strftime(BATCH_ID_FORMAT)


def shadowed_columns(columns: list[str], hash_column: str | None = None) -> list[str]:
    """Source columns that the audit and hash columns will overwrite."""
    added = {*APPENDED_AUDIT, *((hash_column, ROW_HASH) if hash_column else ())}
    return [c for c in columns if c in added]


def add_audit_columns(df: DataFrame, batch_id: str | None, created_by: str,
                      source_system: str, run_ts: dt.datetime | str | None = None) -> DataFrame:
    """Both dates are one value per query: ``run_ts`` if pinned, else the
    query's ``current_timestamp()``. A source column with an audit name is
    overwritten at its own position."""
    now = F.current_timestamp() if run_ts is None else timestamp_literal(run_ts)
    return df.withColumns({
        ETL_CREATED_DATE: now,
        ETL_LAST_UPDATE_DATE: now,
        CREATED_BY: F.lit(created_by),
        TO_PROCESS: F.lit(True),
        SOURCE_SYSTEM: F.lit(source_system),
        BATCH_ID: F.lit(batch_id if batch_id is not None else new_batch_id()),
    })
