"""Canonical values and order-free content checksums.

A content checksum is a multiset checksum: every row becomes two independent
64-bit hashes, and each is summed over all rows. Sums do not depend on the order
or the partitioning of the rows, see repeated rows (an XOR would not), and are
plain aggregates, so they ride along with a write as an ``Observation``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.naming import qcol

#: A hash is summed in a high piece and two lower ones of so many bits.
PIECE_BITS = 22


def _holds(kind: T.DataType, *kinds: type) -> bool:
    if isinstance(kind, kinds):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds(kind.elementType, *kinds)
    if isinstance(kind, T.MapType):
        return _holds(kind.keyType, *kinds) or _holds(kind.valueType, *kinds)
    if isinstance(kind, T.StructType):
        return any(_holds(f.dataType, *kinds) for f in kind.fields)
    return False


def canonical(value: Column, kind: T.DataType) -> Column:
    """``value`` in a form in which equal values are written alike.

    Maps become arrays of entries sorted by key, whatever order they were built
    in; floating-point zeros and NaNs each have one form; all this also inside
    arrays, structs and maps. Values without any of these are left alone.
    """
    if not _holds(kind, T.MapType, T.FloatType, T.DoubleType):
        return value
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        none = F.lit(0.0).cast(kind)
        return (F.when(F.isnan(value), F.lit(float("nan")).cast(kind))
                .when(value == none, none).otherwise(value))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: canonical(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.array_sort(F.transform(F.map_entries(value), lambda e: F.struct(
            canonical(e["key"], kind.keyType).alias("key"),
            canonical(e["value"], kind.valueType).alias("value"))),
            lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    return F.when(value.isNotNull(), F.struct(*[
        canonical(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]))


def row_digests(schema: T.StructType, columns: Iterable[str] | None = None) -> list[Column]:
    """Two independent 64-bit hashes of a row.

    Columns count in name order, so the order of columns does not matter. A NULL
    leaves a hash as it is, so each column is followed by whether it is NULL.
    """
    kinds = {f.name: f.dataType for f in schema.fields}
    parts = []
    for name in sorted(kinds if columns is None else columns):
        value = canonical(qcol(name), kinds[name])
        if isinstance(kinds[name], (T.VariantType, T.NullType)):
            value = F.lit(None).cast("string") if isinstance(kinds[name], T.NullType) \
                else F.to_json(value)
        parts += [value, qcol(name).isNull()]
    return [F.xxhash64(F.lit(seed), *parts) for seed in ("first", "second")]


def digest_sums(digests: Iterable[Column]) -> list[Column]:
    """Aggregates that sum each of the given 64-bit hashes, exactly: in pieces whose
    long sums hold for 2**41 rows, many times faster than a sum of decimals."""
    mask, out = F.lit(2**PIECE_BITS - 1).cast("long"), []
    for i, h in enumerate(digests, 1):
        pieces = [h.bitwiseAND(mask), F.shiftright(h, PIECE_BITS).bitwiseAND(mask),
                  F.shiftright(h, 2 * PIECE_BITS)]
        out += [F.sum(p).alias(f"content_{i}_{k}") for k, p in enumerate(pieces)]
    return out


def content_metrics(schema: T.StructType, columns: Iterable[str] | None = None) -> list[Column]:
    """Aggregates for :func:`content_text`: the sums of both row hashes."""
    return digest_sums(row_digests(schema, columns))


def content_text(row) -> str:
    """The checksum of an aggregated row as text; an empty table's is ``0:0``."""
    return ":".join(str(sum((row[f"content_{i}_{k}"] or 0) << (k * PIECE_BITS) for k in range(3)))
                    for i in (1, 2))
