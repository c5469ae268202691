"""X2: change detection between two snapshots by row hash.

Rows are compared as sets of hashes (the hash is the row identity). With
business key columns, a hash that appears on one side only is classified
against the key's presence on the other side:

=========  ===========================================================
change     meaning
=========  ===========================================================
new        hash only in ``cur``; key absent from ``prev``
changed    hash only in ``cur``; key present in ``prev`` (new version)
removed    hash only in ``prev``; key absent from ``cur``
replaced   hash only in ``prev``; key present in ``cur`` (old version)
=========  ===========================================================

Without keys every difference is ``new`` or ``removed``.

Plan: the first pass sees only keys, hash and side. Both sides are unioned and
aggregated per (key, hash) with map-side partial aggregation, so duplicated
rows or hot keys collapse before the shuffle and no pairs are ever formed; most
rows end there. Key presence is looked up for the keys of the differences only, in
a scan of the key columns alone, and the payload of both sides is fetched in one
join on (key, hash, side) whose one side has one row per pair: adaptive execution
broadcasts it when its measured size is small and splits skewed partitions
otherwise. Keys and hash travel as one struct: it is never NULL itself and NULLs in
it are equal, so the join is a plain equi-join whose partitioning later steps share.

Several rows of one side may share key and hash (columns kept out of the hash);
the smallest one in column order is returned. The first pass counts them, so only
rows that are repeated are aggregated; all others are passed on as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.constants import AUDIT_COLUMNS, BATCH_ID
from tidewater.functions.naming import qcol

CHANGE = "change"


def _at(keys: list[str], hash_column: str):
    """Business key and row hash as one never-NULL value."""
    return F.struct(*[qcol(k).alias(f"k{i}") for i, k in enumerate(keys)],
                    qcol(hash_column).alias("h")).alias("_at")


def _smallest(columns: list[str], df: DataFrame, row_column: str):
    """The smallest row in column order; maps have no order, so by its JSON then."""
    row = F.col(row_column)
    if any("map<" in df.schema[c].dataType.simpleString() for c in columns):
        return F.min_by(row, F.to_json(row))
    return F.min(row)


def detect_changes(prev: DataFrame, cur: DataFrame, hash_column: str,
                   key_columns: Sequence[str] = ()) -> DataFrame:
    """Rows that differ between ``prev`` and ``cur``, in ``cur``'s column order
    followed by columns only ``prev`` has, plus a ``change`` column. Payload
    comes from ``cur`` for new/changed rows and from ``prev`` for
    removed/replaced rows; a column the side lacks is NULL."""
    keys = list(key_columns)
    types = {f.name: f.dataType for df in (prev, cur) for f in df.schema.fields}
    columns = [*cur.columns, *[c for c in prev.columns if c not in cur.columns]]
    slim = None
    for side, df in ((0, prev), (1, cur)):
        part = df.select(_at(keys, hash_column), F.lit(side).alias("_side"))
        slim = part if slim is None else slim.unionByName(part)
    diff = (slim.groupBy("_at").agg(F.max("_side").alias("_last"), F.min("_side").alias("_first"),
                                    F.count(F.lit(1)).alias("_n"))
            .where("_first = _last").select("_at", F.col("_last").alias("_in"), "_n"))
    both = F.lit(False)
    if keys:
        # which sides have the key, for the keys of the differences only
        key = F.struct(*[F.col("_at")[f"k{i}"].alias(f"k{i}") for i in range(len(keys))])
        wanted = diff.select(key.alias("_key")).distinct()
        presence = (slim.select(key.alias("_key"), "_side").join(wanted, "_key", "left_semi")
                    .groupBy("_key").agg((F.min("_side") != F.max("_side")).alias("_both")))
        diff = diff.withColumn("_key", key).join(presence, "_key")
        both = F.col("_both")
    change = (F.when((F.col("_in") == 1) & both, "changed").when(F.col("_in") == 1, "new")
              .when(both, "replaced").otherwise("removed"))
    diff = diff.select("_at", "_in", "_n", change.alias(CHANGE))
    full = None
    for side, df in ((1, cur), (0, prev)):
        part = df.select(_at(keys, hash_column), F.lit(side).alias("_in"), F.struct(*[
            qcol(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c)
            for c in columns]).alias("_row"))
        full = part if full is None else full.unionByName(part)
    found = full.join(diff, ["_at", "_in"])
    single = found.where("_n = 1").select("_row.*", CHANGE)
    repeated = found.where("_n > 1")
    smallest = _smallest(columns, repeated.select("_row.*"), "_row")
    repeated = repeated.groupBy("_at", "_in", CHANGE).agg(smallest.alias("_row"))
    return single.unionByName(repeated.select("_row.*", CHANGE))


def changes_between_batches(lake: DataFrame | str, prev_batch: str, cur_batch: str,
                            hash_column: str, key_columns: Sequence[str] = (),
                            batch_column: str = BATCH_ID, fmt: str = "parquet") -> DataFrame:
    """Compare two batches of a landed table, given as a DataFrame (the batch
    filters become partition filters) or as the lake path (only the two
    batch directories are listed and read). Audit columns are dropped so
    they do not count as changes."""
    if isinstance(lake, str):
        from pyspark.sql import SparkSession

        from tidewater.sources.lake import read_lake
        spark = SparkSession.active()
        prev = read_lake(spark, lake, fmt, batch_id=prev_batch, batch_column=batch_column)
        cur = read_lake(spark, lake, fmt, batch_id=cur_batch, batch_column=batch_column)
    else:
        prev = lake.where(qcol(batch_column) == prev_batch)
        cur = lake.where(qcol(batch_column) == cur_batch)
    prev = prev.select(*[qcol(c) for c in prev.columns if c not in AUDIT_COLUMNS])
    cur = cur.select(*[qcol(c) for c in cur.columns if c not in AUDIT_COLUMNS])
    return detect_changes(prev, cur, hash_column, key_columns)
