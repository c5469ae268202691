"""F1-F2: null implausible timestamps; fill ``ETL_*`` timestamps with now."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tidewater.constants import ETL_PREFIX, MIN_PLAUSIBLE_YEAR
from tidewater.functions.naming import qcol
from tidewater.functions.timestamps import TimeLike, implausible_timestamp, now_for


def timestamp_columns(df: DataFrame, include_ntz: bool = False) -> list[str]:
    kinds = (TimestampType, TimestampNTZType) if include_ntz else (TimestampType,)
    # TimestampNTZType is not a TimestampType subclass, so NTZ is opt-in.
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def sanitize_timestamps(df: DataFrame, as_of: TimeLike = None,
                        min_year: int = MIN_PLAUSIBLE_YEAR, include_ntz: bool = False,
                        future: str = "null", fill_etl: bool = True) -> DataFrame:
    """For each timestamp column: NULL when null, before ``min_year``, after
    ``year(as_of) + 1`` or later than ``as_of``. Then, for columns named
    ``ETL_*``, NULL becomes ``as_of``. DateType is left alone; NTZ columns only
    with ``include_ntz``. One projection; column types are kept."""
    if future not in ("null", "keep"):
        raise ValueError("future must be 'null' or 'keep'")
    targets = set(timestamp_columns(df, include_ntz))
    if not targets:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in df.columns:
        c = qcol(name)
        if name not in targets:
            out.append(c)
            continue
        dtype = types[name]
        cleaned = F.when(implausible_timestamp(c, dtype, as_of, min_year, future),
                         F.lit(None).cast(dtype)).otherwise(c)
        if fill_etl and name.startswith(ETL_PREFIX):
            cleaned = F.coalesce(cleaned, now_for(dtype, as_of))
        out.append(cleaned.alias(name))
    return df.select(*out)
