"""Timestamp plausibility rule and pinned time literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

from tidewater.constants import MIN_PLAUSIBLE_YEAR

TimeLike = dt.datetime | str | None


def timestamp_literal(value: dt.datetime | str, ntz: bool = False) -> Column:
    """A pinned timestamp literal.

    Naive datetimes and strings are wall-clock time in the session zone, so a
    pinned value reads back unchanged whatever the zone is. Aware datetimes
    are instants; as NTZ they become the session zone's wall clock.
    """
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        instant = F.lit(value)
        return instant.cast("timestamp_ntz") if ntz else instant
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz" if ntz else "timestamp")


def now_for(data_type: DataType, as_of: TimeLike) -> Column:
    """``as_of`` (or the query's current time) in the column's own type."""
    ntz = isinstance(data_type, TimestampNTZType)
    if as_of is None:
        return F.localtimestamp() if ntz else F.current_timestamp()
    return timestamp_literal(as_of, ntz=ntz)


def year_of(as_of: TimeLike) -> int:
    """Calendar year of ``as_of``; the driver's current year when unset."""
    if as_of is None:
        return dt.datetime.now().year
    if isinstance(as_of, str):
        return int(as_of.strip()[:4])
    return as_of.year


def implausible_timestamp(c: Column, data_type: DataType, as_of: TimeLike = None,
                          min_year: int = MIN_PLAUSIBLE_YEAR,
                          future: str = "null") -> Column:
    """True where a timestamp is NULL, before ``min_year``, after next year,
    or (with ``future="null"``) later than ``as_of``."""
    if not isinstance(data_type, (TimestampType, TimestampNTZType)):
        raise TypeError(f"not a timestamp type: {data_type}")
    cond = c.isNull() | (F.year(c) < min_year) | (F.year(c) > year_of(as_of) + 1)
    if future == "null":
        cond = cond | (c > now_for(data_type, as_of))
    elif future != "keep":
        raise ValueError("future must be 'null' or 'keep'")
    return cond
