"""P4-P6: row hash, its ``ETL_ROW_HASH`` copy, hash column first."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidewater.constants import ROW_HASH, DEFAULT_HASH_BITS
from tidewater.functions.hashing import hash_input_columns, row_hash_expr
from tidewater.functions.naming import qcol


def add_row_hash(df: DataFrame, hash_column: str | None, exclude: Iterable[str] = (),
                 bits: int = DEFAULT_HASH_BITS, null_safe: bool = False,
                 canonical: bool = False) -> DataFrame:
    """Add ``hash_column`` (first) and ``ETL_ROW_HASH`` (last, or in place).

    The hash covers every column except the audit columns, ``exclude`` and the
    hash column itself, in sorted name order. With no such column it is the
    hash of ``''``. ``hash_column=None`` returns ``df`` unchanged. ``canonical``
    makes equal maps (and zeros, and NaNs) hash alike, also inside other columns.

    The digest is computed once: the second projection only references it.
    """
    if not hash_column:
        return df
    inputs = hash_input_columns(df.columns, hash_column, exclude)
    kinds = {f.name: f.dataType for f in df.schema.fields} if canonical else None
    digest = row_hash_expr(inputs, bits=bits, null_safe=null_safe, kinds=kinds).alias(hash_column)
    rest = [c for c in df.columns if c != hash_column]
    hashed = df.select(digest, *[qcol(c) for c in rest])
    h = qcol(hash_column)
    out = [h]
    for c in rest:
        out.append(h.alias(ROW_HASH) if c == ROW_HASH else qcol(c))
    if ROW_HASH not in rest:
        out.append(h.alias(ROW_HASH))
    return hashed.select(*out)
