"""Digests and membership filters of row hashes, per hash prefix.

Both are small tables with one row per prefix of a 64-bit hash. They are built with
map-side combine, merge by adding (digests) or by OR (filters), and fold to a shorter
prefix by merging neighbours, so tables of unlike depth can be held against each other.

* A *digest* row has the number of rows in its bucket and two sums of independent
  64-bit hashes of (key, row hash). Two batches whose bucket digests are equal hold the
  same rows there (the chance that unlike ones agree is about 2**-128 a bucket).
* A *filter* row is one block of a blocked Bloom filter: four 64-bit words, two bits set
  in each per row hash. A hash whose bits are not all set was never added; one whose
  bits are set may have been.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.content import canonical
from tidewater.functions.naming import qcol

#: Rows a digest bucket and a filter block are sized for (a block has 256 bits).
ROWS_PER_BUCKET = 8
ROWS_PER_BLOCK = 16
LANES = 4
MAX_DEPTH = 48


def depth_for(rows: int, per_bucket: int) -> int:
    """Bits of prefix at which a bucket holds at most about ``per_bucket`` rows."""
    return min(MAX_DEPTH, (max(rows, 1) // per_bucket).bit_length())


def _prefix(value: Column, depth: int) -> Column:
    return F.shiftrightunsigned(value, 64 - depth) if depth else F.lit(0).cast("long")


def _parts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [canonical(qcol(c), df.schema[c].dataType) for c in columns]


def bucket_of(df: DataFrame, hash_column: str, key_columns: Sequence[str], depth: int) -> Column:
    """Bucket of a row: by its key, so that all versions of a key share one, or by its
    row hash if there is no key. Floats count in their canonical form."""
    return _prefix(F.xxhash64(*_parts(df, key_columns or [hash_column])), depth)


def prefix_digests(df: DataFrame, hash_column: str, key_columns: Sequence[str],
                   depth: int) -> DataFrame:
    """``bucket``, ``n``, ``sum_1``, ``sum_2`` of the rows of ``df``. NULL keys and
    hashes count as values of their own; an empty ``df`` has no bucket."""
    row = []
    for c, part in zip([*key_columns, hash_column], _parts(df, [*key_columns, hash_column]),
                       strict=True):
        row += [part, qcol(c).isNull()]
    return df.groupBy(bucket_of(df, hash_column, key_columns, depth).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(38,0)")).alias(name)
          for seed, name in (("first", "sum_1"), ("second", "sum_2"))])


def differing_buckets(prev: DataFrame, prev_depth: int, cur: DataFrame,
                      cur_depth: int) -> tuple[DataFrame, int]:
    """Buckets whose digests differ, and the depth they are given at: the smaller one."""
    depth = min(prev_depth, cur_depth)
    both = None
    for sign, df, own in ((-1, prev, prev_depth), (1, cur, cur_depth)):
        part = df.select(F.shiftrightunsigned("bucket", own - depth).alias("bucket"), *[
            (F.col(c) * sign).cast("decimal(38,0)").alias(c) for c in ("n", "sum_1", "sum_2")])
        both = part if both is None else both.unionByName(part)
    found = (both.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", "sum_1", "sum_2")])
             .where("n != 0 or sum_1 != 0 or sum_2 != 0").select("bucket"))
    return found, depth


def _lanes(column: Column) -> list[Column]:
    """The bits of one hash in the four words of its block."""
    bits = F.xxhash64(F.lit("lanes"), column)
    one = F.lit(1).cast("long")

    def bit(at: int) -> Column:
        return F.call_function("shiftleft", one, F.shiftrightunsigned(bits, at)
                               .bitwiseAND(F.lit(63)).cast("int"))

    return [bit(12 * i).bitwiseOR(bit(12 * i + 6)).alias(f"word_{i}") for i in range(LANES)]


def hash_filter(df: DataFrame, hash_column: str, depth: int) -> DataFrame:
    """``block``, ``word_0`` to ``word_3``: a filter of the hashes of ``df``."""
    h = qcol(hash_column)
    return df.where(h.isNotNull()).select(
        _prefix(F.xxhash64(h), depth).alias("block"), *_lanes(h)).groupBy("block").agg(
        *[F.bit_or(f"word_{i}").alias(f"word_{i}") for i in range(LANES)])


def merge_filters(filters: Sequence[tuple[DataFrame, int]]) -> tuple[DataFrame, int]:
    """One filter of all hashes in ``filters`` (with their depths), at the smallest depth."""
    depth = min(d for _, d in filters)
    both = None
    for df, own in filters:
        part = df.withColumn("block", F.shiftrightunsigned("block", own - depth))
        both = part if both is None else both.unionByName(part)
    return both.groupBy("block").agg(
        *[F.bit_or(f"word_{i}").alias(f"word_{i}") for i in range(LANES)]), depth


def possible_hits(df: DataFrame, hash_column: str, held: DataFrame, depth: int) -> DataFrame:
    """Distinct hashes of ``df`` that ``held`` may have: all that it has, and a few others."""
    h = qcol(hash_column)
    probe = df.where(h.isNotNull()).select(h.alias(hash_column)).distinct().select(
        h.alias("_hash"), _prefix(F.xxhash64(h), depth).alias("block"),
        *[lane.alias(f"_bits_{i}") for i, lane in enumerate(_lanes(h))])
    inside = F.lit(True)
    for i in range(LANES):
        inside &= F.col(f"word_{i}").bitwiseAND(F.col(f"_bits_{i}")) == F.col(f"_bits_{i}")
    return probe.join(held, "block").where(inside).select(F.col("_hash").alias(hash_column))
