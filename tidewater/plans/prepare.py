"""O1 transform: rename -> hash -> audit -> timestamp cleanup.

The order is part of the contract: the hash is taken before the timestamp
cleanup, so a stored NULL may stand for a hashed implausible value.
Catalyst collapses the steps into one projection over the scan: a single
narrow stage, no shuffle, no Python on the data path.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidewater.constants import DEFAULT_HASH_BITS, MIN_PLAUSIBLE_YEAR
from tidewater.operators.audit import add_audit_columns
from tidewater.operators.hashing import add_row_hash
from tidewater.operators.rename import normalize_columns
from tidewater.operators.timestamps import sanitize_timestamps

TimeLike = dt.datetime | str | None


def prepare(df: DataFrame, hash_column: str | None, batch_id: str | None,
            created_by: str, source_system: str, run_ts: TimeLike = None,
            as_of: TimeLike = None, bits: int = DEFAULT_HASH_BITS,
            include_ntz: bool = False, null_safe: bool = False,
            exclude: Iterable[str] = (), min_year: int = MIN_PLAUSIBLE_YEAR,
            future: str = "null", canonical: bool = False) -> DataFrame:
    out = normalize_columns(df)
    out = add_row_hash(out, hash_column, exclude=exclude, bits=bits, null_safe=null_safe,
                       canonical=canonical)
    out = add_audit_columns(out, batch_id, created_by, source_system, run_ts)
    return sanitize_timestamps(out, as_of=as_of, min_year=min_year,
                               include_ntz=include_ntz, future=future)


def prepare_with(df: DataFrame, spec, config) -> DataFrame:
    """``prepare`` driven by a ``TableSpec`` and a ``RunConfig``."""
    return prepare(df, spec.hash_column, config.batch_id, config.created_by,
                   config.source_system, run_ts=config.run_ts, as_of=config.as_of,
                   bits=config.bits, include_ntz=config.include_ntz,
                   null_safe=config.null_safe, exclude=spec.exclude,
                   min_year=config.min_year, future=config.future, canonical=config.canonical)
