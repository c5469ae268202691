"""Digests and hash filters kept beside the batches of a lake.

:func:`index_batch` scans the keys and the row hash of one batch, writes its prefix
digests and its membership filter (``tidewater.operators.digests``) under the batch's
own directory and names them in the next version of the manifest, so they live and go
with the batch. Two readers use them:

* :func:`changes_of_batches` (X2): batches with equal root digests are not read at all.
  Otherwise the digests are held against each other and only rows of differing buckets
  leave the scans; nothing else is exchanged or aggregated.
* :func:`new_rows_of_batch` (X1): the filters of all earlier batches say which hashes of
  a new batch may have been seen. Without any, history is not read; otherwise its hash
  column is scanned, and only rows that are possible hits are exchanged.

Both give exactly the rows of ``changes_between_batches`` and ``dedupe_new_rows``. What
they broadcast is written and counted first; with more than ``max_broadcast`` rows the
plain, fully exchanged plans run instead: a batch most of whose rows differ, or were
seen before, gains nothing from an index. So does a batch without one, or one whose
keys or hash have changed type since.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.constants import AUDIT_COLUMNS, BATCH_ID
from tidewater.functions.naming import qcol
from tidewater.operators import digests as D
from tidewater.operators.changes import detect_changes
from tidewater.operators.dedupe import dedupe_by_hash, dedupe_new_rows
from tidewater.plans.session import scratch_dir
from tidewater.sources import manifest as M
from tidewater.sources.lake import read_version

#: Rows of a broadcast side: bucket numbers (some 30 MB) or row hashes (some 200 MB).
MAX_BROADCAST_BUCKETS = 1_000_000
MAX_BROADCAST_HASHES = 1_000_000


def _name(found: M.Manifest, kind: str, hash_column: str, key_columns: Sequence[str]) -> str:
    """Name of an index; columns by id, so that a rename keeps it."""
    ids = {f.name: M.field_id(f) for f in found.table.fields}
    missing = [c for c in [hash_column, *key_columns] if c not in ids]
    if missing:
        raise ValueError(f"no column {missing}")
    return "-".join([kind, *[str(ids[c]) for c in [hash_column, *key_columns]]])


def _entry(found: M.Manifest, batch: str, kind: str, hash_column: str,
           key_columns: Sequence[str] = ()) -> dict | None:
    """A batch's index, if it has one and its columns still have the types it was made with."""
    b = found.batches[batch]
    entry = b.index.get(_name(found, kind, hash_column, key_columns))
    now = {M.field_id(f): f.dataType for f in found.table.fields}
    written = {M.field_id(f): f.dataType for f in found.schemas[b.schema].fields}
    ids = [M.field_id(found.table[c]) for c in [hash_column, *key_columns]]
    same = all(written.get(i) == now[i] for i in ids)
    return entry if entry and same else None


def _manifest(spark: SparkSession, path: str, *batches: str) -> M.Manifest:
    found = M.read_manifest(spark, path)
    if found is None:
        raise ValueError(f"{path} has no manifest")
    for b in batches:
        if b not in found.batches:
            raise ValueError(f"{path} has no batch {b!r}")
    return found


def index_batch(spark: SparkSession, path: str, batch_id: str, hash_column: str,
                key_columns: Sequence[str] = (), fmt: str = "parquet") -> M.Manifest:
    """Write and publish the digests and the filter of one batch.

    An index of the same columns is replaced. If the batch itself is replaced or taken
    out meanwhile, this raises and publishes nothing. An empty key list digests by row
    hash.
    """
    found, root = _manifest(spark, path, batch_id), path.rstrip("/")
    keys, batch = list(key_columns), found.batches[batch_id]
    digest, member = (_name(found, "digest", hash_column, keys),
                      _name(found, "filter", hash_column, []))
    # with the types the batch was written with, or a wider table would fit no old index
    df = read_version(spark, path, fmt, found, batch_id).select(
        *[qcol(c) for c in dict.fromkeys([hash_column, *keys])])
    written = {M.field_id(f): f.dataType for f in found.schemas[batch.schema].fields}
    if any(written.get(M.field_id(found.table[c])) != found.table[c].dataType
           for c in df.columns):
        raise ValueError(f"{batch_id}: a key or the hash has changed type since it was written")
    rows = batch.rows if batch.rows is not None else df.count()
    entries = {}
    for name, table, depth in (
            (digest, D.prefix_digests, D.depth_for(rows, D.ROWS_PER_BUCKET)),
            (member, D.hash_filter, D.depth_for(rows, D.ROWS_PER_BLOCK))):
        out = f"{batch.dir}/_index/{name}-{uuid.uuid4().hex}"
        if name == digest:
            obs = Observation(f"digest_{uuid.uuid4().hex}")
            made = table(df, hash_column, keys, depth).observe(
                obs, *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
                       for c in ("n", "sum_1", "sum_2")])
        else:
            made = table(df, hash_column, depth)
        made.write.option("compression", "zstd").parquet(f"{root}/{out}")
        entries[name] = {"dir": out, "depth": depth}
        if name == digest:
            entries[name]["root"] = [str(int(obs.get[c] or 0)) for c in ("n", "sum_1", "sum_2")]

    def change(now: M.Manifest | None) -> M.Manifest:
        held = now.batches.get(batch_id) if now else None
        if held is None or held.dir != batch.dir:
            raise ValueError(f"{path}: batch {batch_id!r} was replaced meanwhile")
        return replace(now, batches={**now.batches, batch_id: replace(
            held, index={**held.index, **entries})})

    return M.commit(spark, path, change)


def _kept(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` as a table in the shared scratch folder, and its rows."""
    spark, obs = df.sparkSession, Observation(f"{name}_{uuid.uuid4().hex}")
    path = scratch_dir(spark, name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(obs.get["rows"])


def changes_of_batches(spark: SparkSession, path: str, prev_batch: str, cur_batch: str,
                       hash_column: str, key_columns: Sequence[str] = (), fmt: str = "parquet",
                       max_broadcast: int = MAX_BROADCAST_BUCKETS) -> DataFrame:
    """X2 between two batches of a lake, by their digests where both have them."""
    found, keys = _manifest(spark, path, prev_batch, cur_batch), list(key_columns)
    sides = []
    for b in (prev_batch, cur_batch):
        df = read_version(spark, path, fmt, found, b)
        sides.append(df.select(*[qcol(c) for c in df.columns if c not in AUDIT_COLUMNS]))
    entries = [_entry(found, b, "digest", hash_column, keys) for b in (prev_batch, cur_batch)]
    if all(entries):
        if entries[0]["root"] == entries[1]["root"]:
            sides = [df.where(F.lit(False)) for df in sides]
        else:
            tables = [spark.read.parquet(f"{path.rstrip('/')}/{e['dir']}") for e in entries]
            unlike, depth = D.differing_buckets(tables[0], entries[0]["depth"],
                                                tables[1], entries[1]["depth"])
            unlike, n = _kept(unlike, "x2_buckets")
            if n <= max_broadcast:
                sides = [_in_buckets(df, hash_column, keys, depth, unlike) for df in sides]
    return detect_changes(sides[0], sides[1], hash_column, keys)


def _in_buckets(df: DataFrame, hash_column: str, keys: list[str], depth: int,
                buckets: DataFrame) -> DataFrame:
    at = D.bucket_of(df, hash_column, keys, depth)
    name = "_bucket"
    while name in df.columns:
        name = "_" + name
    return df.withColumn(name, at).join(
        F.broadcast(buckets.select(F.col("bucket").alias(name))), name, "left_semi").select(
        *[qcol(c) for c in df.columns])


def new_rows_of_batch(spark: SparkSession, path: str, batch_id: str, hash_column: str,
                      fmt: str = "parquet", order_by: Sequence[str] = (BATCH_ID,),
                      max_broadcast: int = MAX_BROADCAST_HASHES) -> DataFrame:
    """X1 for one batch of a lake: its rows whose hash no earlier batch (by batch id)
    has, one row per hash. Rows with a NULL hash are always new, as in
    ``dedupe_new_rows``."""
    found = _manifest(spark, path, batch_id)
    batch = read_version(spark, path, fmt, found, batch_id)
    filters, indexed, plain = [], {}, {}
    for name, b in found.batches.items():
        if name >= batch_id:
            continue
        entry = _entry(found, name, "filter", hash_column)
        (indexed if entry else plain)[name] = b
        if entry:
            filters.append((spark.read.parquet(f"{path.rstrip('/')}/{entry['dir']}"),
                            entry["depth"]))

    def history(batches: dict[str, M.Batch]) -> DataFrame:
        return M.read_batches(spark, path, fmt, found, batches, {})

    if not filters:
        seen = history(plain)
    else:
        # one probe per depth: folding a large batch's filter to a small one's fills it up
        groups: dict[int, list[tuple[DataFrame, int]]] = {}
        for f in filters:
            groups.setdefault(f[1], []).append(f)
        hits = None
        for group in groups.values():
            part = D.possible_hits(batch, hash_column, *D.merge_filters(group))
            hits = part if hits is None else hits.unionByName(part)
        hits, n = _kept(hits.distinct(), "x1_hits")
        seen = history(plain) if plain else None
        if n > max_broadcast:
            seen = history({**plain, **indexed})
        elif n:
            known = (history(indexed).select(qcol(hash_column).alias(hash_column))
                     .join(F.broadcast(hits), hash_column, "left_semi").distinct())
            seen = known if seen is None else seen.select(
                qcol(hash_column).alias(hash_column)).unionByName(known)
    if seen is None:
        return dedupe_by_hash(batch, hash_column, order_by)
    return dedupe_new_rows(seen, batch, hash_column, order_by)
