"""X1: one row per row hash, keeping the earliest batch.

Incremental loads append the full snapshot every run, so the lake holds one
copy of an unchanged row per batch. This keeps, for each hash, the row with
the smallest ``(order_by..., remaining columns...)``; the tie-break on the
remaining columns makes the pick deterministic.

Plan: one hash-partitioned aggregate with ``min(struct)``. The partial
aggregate runs map-side, so a hash repeated in a third of all rows is
reduced to one row per map task before the shuffle; no group is ever
collected into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.constants import BATCH_ID
from tidewater.functions.hashing import hash_key
from tidewater.functions.naming import qcol


def dedupe_by_hash(df: DataFrame, hash_column: str,
                   order_by: Sequence[str] = (BATCH_ID,)) -> DataFrame:
    order = [c for c in order_by if c in df.columns and c != hash_column]
    rest = [c for c in df.columns if c != hash_column and c not in order]
    row = F.struct(*[qcol(c) for c in [*order, *rest, hash_column]])
    maps = [c for c in rest if "map<" in df.schema[c].dataType.simpleString()]
    best = F.min_by(row, F.struct(*[qcol(c) for c in order], F.to_json(row))) if maps else F.min(row)
    picked = df.groupBy(hash_key(qcol(hash_column)).alias("_key")).agg(best.alias("_best"))
    return picked.select(*[F.col("_best").getField(c).alias(c) for c in df.columns])


def keep_hashes(df: DataFrame, hash_column: str, table: str, buckets: int) -> None:
    """Append the hashes of kept rows to a catalog table bucketed by hash.

    Later batches are held against it without exchanging it. At 100 TB, choose
    ``buckets`` so that a bucket of the whole history stays within some GB.
    """
    (df.select(qcol(hash_column).alias(hash_column)).write.mode("append")
     .bucketBy(buckets, hash_column).sortBy(hash_column).saveAsTable(table))


def dedupe_new_rows(seen: DataFrame, batch: DataFrame, hash_column: str,
                    order_by: Sequence[str] = (BATCH_ID,)) -> DataFrame:
    """Incremental X1: rows of a new ``batch`` whose hash is not in ``seen``
    (the de-duplicated table so far, or any earlier data carrying the hash).

    Appending the result to the de-duplicated table keeps it equal to
    ``dedupe_by_hash`` over all batches, when batches arrive in ``order_by``
    order: the batch is de-duplicated first (hot hashes collapse map-side),
    then a left-anti join against the hash column of ``seen`` drops what was
    already kept. An anti join never fans out, and repeats in ``seen`` do no
    harm. Only the hash column of history is read; it is exchanged once a run,
    unless ``seen`` is a table written by :func:`keep_hashes`, which is read
    bucket by bucket.
    """
    fresh = dedupe_by_hash(batch, hash_column, order_by)
    known = seen.select(qcol(hash_column).alias(hash_column))
    return fresh.join(known, on=hash_column, how="left_anti").select(
        *[qcol(c) for c in batch.columns])
