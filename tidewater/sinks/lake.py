"""K1: land a prepared frame in the lake, one directory per batch.

A load is staged, audited and published (write, audit, publish):

* :func:`stage` writes the batch to a directory of its own that no reader sees,
  counting the rows (and, if asked, summing their content) in the same pass;
* :func:`read_staged` reads it back for the audit;
* :func:`publish` makes it visible in one step by adding a version to the lake's
  manifest (``tidewater.sources.manifest``), :func:`discard` deletes it.

``historical`` replaces all batches of the table, ``incremental`` adds the batch
or replaces the batch with the same id. Readers see the state before or the state
after, never a mixture; a failing load leaves the old rows. Directories that the
last versions no longer name are deleted after a later load, so running readers
keep their files; what a crashed load left behind goes with :func:`vacuum`.

:func:`write_lake` does all of it. An empty frame writes nothing in either mode.
Layouts other than one directory per batch, and formats that do not store column
names, are written in place by Spark's own overwrite.

The row count is an ``Observation`` collected in the same pass as the write, so
counting never re-reads the source. Task retries after a lost executor are
absorbed by the file committer; observed metrics count each task once.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.constants import BATCH_ID, HISTORICAL
from tidewater.functions.content import content_text, digest_sums, row_digests
from tidewater.functions.naming import qcol
from tidewater.sinks.modes import validate_mode
from tidewater.sources import manifest as M
from tidewater.sources.files import delete_dir, escape_partition_value, list_names
from tidewater.sources.lake import NAMED_FORMATS, SCHEMA_DIR, merged_schema, stored_schema

#: Default codec of lake and path targets (any format's own default applies
#: where it has no such option).
COMPRESSION = {"parquet": "zstd", "orc": "zstd"}

#: Row hashes do not compress beyond four bits a digit: a higher level takes longer
#: and leaves more (lineitem: 358 MB at level 1, 368 at 3).
ZSTD_LEVEL = "parquet.compression.codec.zstd.level"


def with_codec(fmt: str, options: Mapping[str, str] | None) -> dict[str, str]:
    opts = dict(options or {})
    given = {k.lower() for k in opts}
    if fmt in COMPRESSION and "compression" not in given:
        opts["compression"] = COMPRESSION[fmt]
        if fmt == "parquet" and ZSTD_LEVEL not in given:
            opts[ZSTD_LEVEL] = "1"
    return opts


@dataclass(frozen=True)
class Staged:
    """A load that is written but not yet visible. ``schema`` has column ids."""

    path: str
    load: str
    fmt: str
    schema: T.StructType
    batches: tuple[str, ...]
    rows: int
    content: str | None = None
    renames: Mapping[str, str] | None = None


def versioned(fmt: str, partition_by: tuple[str, ...] = (BATCH_ID,)) -> bool:
    """Whether a lake of this layout has a manifest."""
    return fmt in NAMED_FORMATS and tuple(partition_by) == (BATCH_ID,)


def _current(spark: SparkSession, path: str) -> M.Manifest | None:
    return M.read_manifest(spark, path) or M.adopted(spark, path, stored_schema(spark, path))


def _renamed(now: M.Manifest | None, renames: Mapping[str, str] | None,
             new: list[str]) -> M.Manifest | None:
    """The table with the columns renamed that a batch brings under a new name."""
    if now is None or not renames:
        return now
    names = set(now.table.names)
    return replace(now, table=T.StructType([
        T.StructField(renames[f.name], f.dataType, True, f.metadata)
        if f.name in renames and renames[f.name] in new and renames[f.name] not in names
        else f for f in now.table.fields]))


def stage(df: DataFrame, path: str, mode: str, fmt: str = "parquet",
          options: Mapping[str, str] | None = None, content: bool = False,
          renames: Mapping[str, str] | None = None, batch_id: str | None = None) -> Staged:
    """Write a load that readers do not see yet.

    ``batch_id``: the single batch ``df`` holds, if the caller knows it. Then the rows
    go to its directory as they come; else Spark sorts every task's rows by batch
    first, which spills. A row of another batch raises and nothing is left behind.

    A column that cannot keep or widen its type raises before anything is written.
    ``renames`` maps old column names to new ones: a lake column with an old name
    gets the new one when a batch brings it, and keeps its history.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    now = _renamed(_current(spark, path), renames, df.columns)
    schema = M.with_ids(df.schema, now.table if now else None)
    if validate_mode(mode) != HISTORICAL:
        M.evolved(now.table if now else None, schema)
    load = uuid.uuid4().hex
    place = f"{root}/{M.DATA_DIR}/_load={load}"
    named = df.select(*[qcol(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields])
    metrics = [F.count(F.lit(1)).alias("rows")]
    if batch_id is None:
        metrics.append(F.collect_set(BATCH_ID).alias("batches"))
    else:
        same = qcol(BATCH_ID).eqNullSafe(F.lit(batch_id))
        metrics.append(F.sum(F.when(same, 0).otherwise(1)).alias("others"))
    sums: list[str] = []
    if content:
        # hashed in the projection below, which Spark compiles; observed metrics are interpreted
        sums = [f"_content_{load}_{i}" for i in (1, 2)]
        named = named.select("*", *[h.alias(c) for h, c in zip(row_digests(df.schema), sums)])
        metrics += digest_sums(map(F.col, sums))
    obs = Observation(f"staged_{load}")
    watched = named.observe(obs, *metrics).drop(*sums)
    if batch_id is not None:
        # a constant again: the metrics hide from Spark that there is nothing to sort
        watched = watched.withColumn(BATCH_ID, F.lit(batch_id).cast(schema[BATCH_ID].dataType))
    (watched.write.format(fmt).partitionBy(BATCH_ID).options(**with_codec(fmt, options))
     .save(place))
    got = obs.get
    if batch_id is not None and got["others"]:
        delete_dir(spark, place)
        raise ValueError(f"{got['others']} row(s) are not of batch {batch_id!r}")
    rows = int(got["rows"])
    batches = got["batches"] if batch_id is None else [batch_id] * (rows > 0)
    return Staged(path, load, fmt, schema, tuple(sorted(batches)), rows,
                  content_text(got) if content else None, renames)


def _entries(spark: SparkSession, staged: Staged, schema: int) -> dict[str, M.Batch]:
    single = len(staged.batches) == 1
    return {b: M.Batch(f"{M.DATA_DIR}/_load={staged.load}/{BATCH_ID}="
                       f"{escape_partition_value(spark, b)}", schema,
                       staged.rows if single else None, staged.content if single else None)
            for b in staged.batches}


def read_staged(spark: SparkSession, staged: Staged) -> DataFrame:
    """The rows of a load that may not be visible yet."""
    found = M.Manifest(0, staged.schema, (staged.schema,), _entries(spark, staged, 0))
    return M.read_batches(spark, staged.path, staged.fmt, found, found.batches, {})


def publish(spark: SparkSession, staged: Staged, mode: str) -> M.Manifest:
    """Make a load visible: instead of all batches (``historical``), or beside the
    others (``incremental``)."""
    whole = validate_mode(mode) == HISTORICAL

    def change(now: M.Manifest | None) -> M.Manifest:
        now = now or M.adopted(spark, staged.path, stored_schema(spark, staged.path))
        if whole or now is None:
            return M.Manifest(0, staged.schema, (staged.schema,), _entries(spark, staged, 0))
        now = _renamed(now, staged.renames, staged.schema.names)
        # another load may have been published since this one was staged
        schema = M.with_ids(staged.schema, now.table)
        schemas = now.schemas if schema in now.schemas else (*now.schemas, schema)
        return replace(now, table=M.evolved(now.table, schema), schemas=schemas, batches={
            **now.batches, **_entries(spark, staged, schemas.index(schema))})

    after = M.commit(spark, staged.path, change)
    _collect(spark, staged.path, after)
    return after


def discard(spark: SparkSession, staged: Staged) -> None:
    delete_dir(spark, f"{staged.path.rstrip('/')}/{M.DATA_DIR}/_load={staged.load}")


def _dirs(found: M.Manifest | None) -> set[str]:
    return {b.dir for b in found.batches.values()} if found else set()


def _collect(spark: SparkSession, path: str, after: M.Manifest) -> None:
    """Delete the directories that the version ``KEPT_VERSIONS`` back named and no
    later one does. A load that is only staged is named by none and stays."""
    root, oldest = path.rstrip("/"), after.version - M.KEPT_VERSIONS
    if oldest < 1:
        return
    gone = _dirs(M.read_manifest(spark, path, oldest))
    for v in range(oldest + 1, after.version + 1):
        gone -= _dirs(after if v == after.version else M.read_manifest(spark, path, v))
    for d in sorted(gone):
        delete_dir(spark, f"{root}/{d}")
    delete_dir(spark, f"{root}/{M.MANIFEST_DIR}/{oldest:020d}.json")


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete every directory that the newest version does not name, older versions
    included: run it while nothing writes to or reads from the lake. Returns them."""
    root, now = path.rstrip("/"), M.read_manifest(spark, path)
    if now is None:
        return []
    live = _dirs(now)
    gone = []
    for load in list_names(spark, f"{root}/{M.DATA_DIR}") or []:
        for d in list_names(spark, f"{root}/{M.DATA_DIR}/{load}") or []:
            if d.startswith(f"{BATCH_ID}=") and f"{M.DATA_DIR}/{load}/{d}" not in live:
                gone.append(f"{M.DATA_DIR}/{load}/{d}")
        if not any(x.startswith(f"{M.DATA_DIR}/{load}/") for x in live):
            gone.append(f"{M.DATA_DIR}/{load}")
    gone += [d for d in list_names(spark, path) or []
             if d.startswith(f"{BATCH_ID}=") and d not in live]
    gone += [f"{M.MANIFEST_DIR}/{v:020d}.json" for v in M.versions(spark, path)
             if v != now.version]
    for d in gone:
        delete_dir(spark, f"{root}/{d}")
    return gone


def write_lake(df: DataFrame, path: str, mode: str, fmt: str = "parquet",
               options: Mapping[str, str] | None = None,
               partition_by: tuple[str, ...] = (BATCH_ID,), content: bool = False,
               renames: Mapping[str, str] | None = None, batch_id: str | None = None) -> int:
    """Write, publish and return the number of rows written. ``batch_id`` as in :func:`stage`."""
    m = validate_mode(mode)
    spark = df.sparkSession
    if not versioned(fmt, partition_by):
        if m == HISTORICAL and df.isEmpty():
            return 0
        return _write_in_place(df, path, m, fmt, options, partition_by)
    staged = stage(df, path, m, fmt, options, content, renames, batch_id)
    if not staged.rows:
        discard(spark, staged)
        return 0
    publish(spark, staged, m)
    return staged.rows


def _write_in_place(df: DataFrame, path: str, mode: str, fmt: str,
                    options: Mapping[str, str] | None, partition_by: tuple[str, ...]) -> int:
    spark, replaced = df.sparkSession, mode == HISTORICAL
    schema = merged_schema(None if replaced or fmt not in NAMED_FORMATS
                           else stored_schema(spark, path), df.schema)
    obs = Observation(f"landed_{uuid.uuid4().hex}")
    writer = (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt)
              .mode("overwrite").options(**with_codec(fmt, options)))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("partitionOverwriteMode",
                  "static" if replaced or not partition_by else "dynamic").save(path)
    rows = int(obs.get["rows"])
    if rows and fmt in NAMED_FORMATS and (replaced or stored_schema(spark, path) != schema):
        (spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
         .write.mode("overwrite").text(f"{path.rstrip('/')}/{SCHEMA_DIR}"))
    return rows


def drop_batch(spark: SparkSession, path: str, batch_id: str,
               batch_column: str = BATCH_ID) -> bool:
    """Take one batch out of the lake; False if there was none."""
    now = M.read_manifest(spark, path)
    if now is None:
        value = escape_partition_value(spark, batch_id)
        return delete_dir(spark, f"{path.rstrip('/')}/{batch_column}={value}")
    if batch_id not in now.batches:
        return False
    after = M.commit(spark, path, lambda found: replace(found, batches={
        k: b for k, b in found.batches.items() if k != batch_id}))
    _collect(spark, path, after)
    return True
