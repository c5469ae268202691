"""Row-hash expression.

The hash text is every business column cast to string, NULL as ``''``,
in sorted name order, joined with ``||``; the digest is SHA-2 lowercase hex.
Everything is a JVM expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.constants import AUDIT_COLUMNS, HASH_DELIMITER, DEFAULT_HASH_BITS
from tidewater.functions.content import canonical
from tidewater.functions.naming import qcol

SHA2_BITS = (224, 256, 384, 512)


def hash_input_columns(columns: Iterable[str], hash_column: str,
                       exclude: Iterable[str] = ()) -> list[str]:
    """Business columns: all minus audit columns, ``exclude`` and the hash column, sorted."""
    skip = set(AUDIT_COLUMNS) | set(exclude) | {hash_column}
    return sorted(c for c in columns if c not in skip)


def row_hash_expr(columns: list[str], bits: int = DEFAULT_HASH_BITS,
                  null_safe: bool = False,
                  kinds: Mapping[str, T.DataType] | None = None) -> Column:
    """SHA-2 of the business columns, in the given order.

    ``null_safe=False`` keeps the load contract byte for byte (NULL and ``''``
    hash alike, and so do delimiter shifts between neighbours).
    ``null_safe=True`` hashes a JSON object of the columns instead, which
    keeps NULL, ``''`` and delimiter text apart. With ``kinds`` (the columns' types)
    nested values are put into their canonical form first: the text of a map depends
    on the order it was built in, that of its sorted entries does not. Flat columns
    keep their bytes, but for ``-0.0``, which is written ``0.0``.
    """
    if bits not in SHA2_BITS:
        raise ValueError(f"bits must be one of {SHA2_BITS}, got {bits}")
    if not columns:
        return F.sha2(F.lit(""), bits)
    texts = {c: (canonical(qcol(c), kinds[c]) if kinds else qcol(c)).cast("string")
             for c in columns}
    if null_safe:
        text = F.to_json(F.struct(*[t.alias(c) for c, t in texts.items()]),
                         {"ignoreNullFields": "false"})
    else:
        text = F.concat_ws(HASH_DELIMITER, *[F.coalesce(t, F.lit("")) for t in texts.values()])
    return F.sha2(text, bits)


def hash_key(column: Column) -> Column:
    """A row hash as the bytes it stands for: half the size of its hex text to
    group, exchange and compare. Other text keeps its own bytes; a leading byte
    keeps the two apart, and NULL is empty."""
    # written back, the bytes give the same text: lower-case hex and nothing else
    is_hex = (F.length(column) > 0) & (F.lower(F.hex(F.unhex(column))) == column)
    return F.coalesce(F.when(is_hex, F.concat(F.lit(b"\x01"), F.unhex(column)))
                      .otherwise(F.concat(F.lit(b"\x00"), F.encode(column, "UTF-8"))),
                      F.lit(b""))
