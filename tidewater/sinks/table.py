"""K2/K4: write a batch to a load target and count what landed there.

Target kinds (``tidewater.plans.spec.Target``):

* ``path``      files at a path (parquet by default), partitioned by batch; written to a
  hidden directory first and published after the audit (``versioned`` targets have a
  manifest like the lake and are read with ``read_lake``);
* ``table``     a catalog table, partitioned by batch;
* ``jdbc``      a database table through Spark's JDBC writer;
* ``connector`` any other Spark connector taking ``dbtable``.

Replace-keeping-schema is a truncate for databases and one insert-overwrite
for catalog tables; a catalog table that lacks a column of the batch gets it
first, so no column is lost. Incremental loads to ``path`` and ``table`` targets
overwrite only their own batch partition, so a re-run is idempotent;
database targets append (with ``replace_batch`` the batch's rows are
deleted first, which makes JDBC re-runs idempotent too).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.constants import BATCH_ID, HISTORICAL, INCREMENTAL
from tidewater.functions.naming import qcol
from tidewater.sinks.modes import LoadAction
from tidewater.sinks.lake import (
    Staged, discard, drop_batch, publish, read_staged, stage, versioned, with_codec,
)
from tidewater.sources.catalog import split_table_name, sql_text, table_name
from tidewater.sources.files import delete_dir, list_names, move
from tidewater.sources.lake import merged_schema


#: Where loads of path targets wait for their audit.
STAGE_DIR = "_tidewater_stage"


def qualify(name: str, default_database: str | None, default_schema: str | None) -> str:
    """K4: a fully qualified ``db.schema.table`` where defaults are known."""
    db, schema, table = split_table_name(name, default_database, default_schema)
    return ".".join(p for p in (db, schema, table) if p)


def _partition_by(target) -> list[str]:
    return list(target.partition_by or ())


def write_target(df: DataFrame, target, action: LoadAction,
                 batch_id: str | None = None) -> None:
    """``batch_id``: the single batch ``df`` holds; lets an incremental load
    into a catalog table replace its own partition on a re-run."""
    kind = target.kind
    if kind == "path":
        if can_stage(target):
            spark = df.sparkSession
            publish_target(spark, stage_target(df, target, action, batch_id), action)
            return
        w = (df.write.format(target.format)
             .options(**with_codec(target.format, target.options)).mode("overwrite"))
        if target.partition_by:
            w = w.partitionBy(*_partition_by(target))
        dynamic = not action.replace and bool(target.partition_by)
        if not action.replace and not target.partition_by:
            w = w.mode("append")
        w.option("partitionOverwriteMode", "dynamic" if dynamic else "static").save(target.name)
        return
    if kind == "table":
        spark = df.sparkSession
        name = table_name(target)
        if action.creates:
            w = df.write.format(target.format).options(**dict(target.options)).mode("overwrite")
            if target.partition_by:
                w = w.partitionBy(*_partition_by(target))
            w.saveAsTable(name)
            return
        # Keep the table definition, with the columns it lacks added, and
        # insert by name: a column the batch lacks is NULL.
        add_missing_columns(df, name)
        have = set(df.columns)
        fields = spark.table(name).schema.fields
        aligned = df.select(*[qcol(f.name) if f.name in have
                              else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
        if action.replace:
            _overwrite_table(aligned, name)
        elif batch_id is not None and list(target.partition_by or ()) == [BATCH_ID]:
            _overwrite_batch_partition(aligned, name, BATCH_ID, batch_id)
        else:
            aligned.write.insertInto(name, overwrite=False)
        return
    if kind == "jdbc":
        opts = dict(target.options)
        url = opts.pop("url")
        if target.replace_batch and batch_id is not None and not action.replace:
            delete_jdbc_batch(df.sparkSession, target, batch_id)
        w = (df.write.format("jdbc").option("url", url)
             .option("dbtable", qualify(target.name, target.default_database,
                                        target.default_schema))
             .options(**opts).mode(action.save_mode))
        if action.keep_schema and action.replace:
            w = w.option("truncate", "true")
        w.save()
        return
    if kind == "connector":
        w = (df.write.format(target.format).options(**dict(target.options))
             .option("dbtable", qualify(target.name, target.default_database,
                                        target.default_schema))
             .mode(action.save_mode))
        if action.keep_schema and action.replace:
            w = w.options(**dict(target.truncate_options))
        w.save()
        return
    raise ValueError(f"unknown target kind {kind!r}")


def add_missing_columns(df: DataFrame, table: str) -> list[str]:
    """Add the columns of ``df`` that a catalog table lacks; a column whose type
    differs raises. Returns the added names."""
    spark = df.sparkSession
    merged = merged_schema(spark.table(table).schema, df.schema)
    known = {f.name.lower() for f in spark.table(table).schema.fields}
    added = [f for f in merged.fields if f.name.lower() not in known]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS (" + ", ".join(
            "`" + f.name.replace("`", "``") + "` " + f.dataType.simpleString()
            for f in added) + ")")
    return [f.name for f in added]


def check_types(df: DataFrame, target) -> None:
    """A path target whose files have a column with another type raises before
    anything is written (one file's schema is read)."""
    found = df.sparkSession.read.format(target.format).load(target.name).schema
    merged_schema(type(found)([f for f in found.fields
                               if f.name not in (target.partition_by or ())]),
                  df.drop(*(target.partition_by or ())).schema)


def _overwrite_table(df: DataFrame, table: str) -> None:
    """Replace all rows in one statement, whatever the session's overwrite mode:
    if it fails the old rows are still there, and external tables work too.

    The mode is a session setting, so the statement runs in a session of its own
    with the settings of this one: loads on other threads never see it change.
    """
    spark = df.sparkSession
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    own.catalog.setCurrentCatalog(spark.catalog.currentCatalog())
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    view = f"tidewater_replace_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        (own.table(f"{spark.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{view}")
         .write.insertInto(table, overwrite=True))
    finally:
        spark.catalog.dropGlobalTempView(view)
        spark.catalog.refreshTable(table)


@dataclass(frozen=True)
class StagedTarget:
    """A load that is written beside a path target but not yet visible there."""

    target: object
    dir: str
    schema: T.StructType
    lake: Staged | None = None


def can_stage(target) -> bool:
    """Path targets with one directory per batch are written, audited, published."""
    return target.kind == "path" and versioned(target.format, tuple(target.partition_by or ()))


def stage_target(df: DataFrame, target, action: LoadAction,
                 batch_id: str | None = None) -> StagedTarget:
    """Write a load to a hidden directory of the target; ``batch_id`` as in ``stage``."""
    if target.versioned:
        held = stage(df, target.name, HISTORICAL if action.replace else INCREMENTAL,
                     target.format, target.options, batch_id=batch_id)
        return StagedTarget(target, "", df.schema, held)
    if not action.creates:
        check_types(df, target)
    place = f"{target.name.rstrip('/')}/{STAGE_DIR}/{uuid.uuid4().hex}"
    (df.write.format(target.format).options(**with_codec(target.format, target.options))
     .partitionBy(*_partition_by(target)).save(place))
    return StagedTarget(target, place, df.schema)


def read_staged_target(spark: SparkSession, staged: StagedTarget) -> DataFrame:
    if staged.lake is not None:
        return read_staged(spark, staged.lake)
    return spark.read.format(staged.target.format).schema(staged.schema).load(staged.dir)


def publish_target(spark: SparkSession, staged: StagedTarget, action: LoadAction) -> None:
    """Make a staged load visible.

    A versioned target changes in one step. A plain one changes by renaming
    directories: a new batch is one rename; where old directories are in the way
    they are renamed away first, and back again if something fails. That takes
    milliseconds on a file system; on an object store, where renaming copies, use
    a versioned target.
    """
    if staged.lake is not None:
        publish(spark, staged.lake, HISTORICAL if action.replace else INCREMENTAL)
        return
    root = staged.target.name.rstrip("/")
    new = [n for n in list_names(spark, staged.dir) or [] if n.startswith(f"{BATCH_ID}=")]
    have = list_names(spark, root) or []
    away = [n for n in have if (not n.startswith(("_", ".")) if action.replace else n in new)]
    kept = f"{staged.dir}.old"
    done: list[tuple[str, str]] = []
    try:
        for n in away:
            move(spark, f"{root}/{n}", f"{kept}/{n}")
            done.append((f"{kept}/{n}", f"{root}/{n}"))
        for n in new:
            move(spark, f"{staged.dir}/{n}", f"{root}/{n}")
            done.append((f"{root}/{n}", f"{staged.dir}/{n}"))
    except Exception:
        for now, before in reversed(done):
            move(spark, now, before)
        raise
    if "_SUCCESS" not in have:
        move(spark, f"{staged.dir}/_SUCCESS", f"{root}/_SUCCESS")
    delete_dir(spark, kept)
    delete_dir(spark, staged.dir)


def discard_target(spark: SparkSession, staged: StagedTarget) -> None:
    if staged.lake is not None:
        discard(spark, staged.lake)
    else:
        delete_dir(spark, staged.dir)


def drop_target_batch(spark: SparkSession, target, batch_id: str) -> bool:
    """Remove one batch from a target (an empty re-run); False where nothing
    can be removed: a target not partitioned by batch, or a database target
    without ``replace_batch``."""
    by_batch = list(target.partition_by or ()) == [BATCH_ID]
    if target.kind == "path" and by_batch:
        return drop_batch(spark, target.name, batch_id)
    if target.kind == "table" and by_batch:
        spark.sql(f"ALTER TABLE {table_name(target)} DROP IF EXISTS PARTITION "
                  f"(`{BATCH_ID}` = {sql_text(batch_id)})")
        return True
    if target.kind == "jdbc" and target.replace_batch:
        delete_jdbc_batch(spark, target, batch_id)
        return True
    return False


def target_columns(spark: SparkSession, target, batch_id: str | None = None) -> list[str] | None:
    """Column names of a file or catalog target; None for others."""
    if target.kind == "table":
        return spark.table(table_name(target)).columns
    if target.kind == "path" and list(target.partition_by or ()) == [BATCH_ID] and batch_id:
        from tidewater.sources.lake import read_lake
        return read_lake(spark, target.name, target.format, batch_id=batch_id).columns
    if target.kind == "path":
        return spark.read.format(target.format).load(target.name).columns
    return None


def _overwrite_batch_partition(df: DataFrame, table: str, batch_column: str,
                               batch_id: str) -> None:
    """Replace one batch partition of a catalog table (static partition
    spec: only that partition is touched, whatever the session settings)."""
    spark = df.sparkSession
    view = f"tidewater_batch_{uuid.uuid4().hex}"
    rest = [c for c in df.columns if c != batch_column]
    df.createOrReplaceTempView(view)
    try:
        cols = ", ".join("`" + c.replace("`", "``") + "`" for c in rest)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION "
                  f"(`{batch_column}` = {sql_text(batch_id)}) SELECT {cols} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def delete_jdbc_batch(spark: SparkSession, target, batch_id: str,
                      batch_column: str = BATCH_ID) -> None:
    """Delete one batch from a JDBC target before it is appended again.

    Spark's JDBC writer cannot run a DELETE; its reader runs
    ``sessionInitStatement`` once per read partition before reading, so a
    one-partition read of ``SELECT 1`` executes the DELETE once. Limits: a
    retried or speculative task runs it again (harmless before the append), and
    the delete and the append are two transactions.
    """
    from tidewater.sources.jdbc import read_jdbc
    opts = {k: v for k, v in target.options.items() if k not in ("url", "numPartitions")}
    name = qualify(target.name, target.default_database, target.default_schema)
    opts["sessionInitStatement"] = (f"DELETE FROM {name} WHERE {batch_column} = "
                                    f"{sql_text(batch_id)}")
    read_jdbc(spark, target.options["url"], query="SELECT 1 AS done", options=opts).collect()


def count_target(spark: SparkSession, target, batch_id: str | None = None,
                 batch_column: str = BATCH_ID) -> int:
    """Rows in the target, or in one batch of it. The batch filter is a
    partition filter (files) or a pushed-down WHERE (databases)."""
    if target.kind in ("path", "table"):
        if target.kind == "path" and target.partition_by and batch_id is not None:
            from tidewater.sources.lake import read_lake
            return read_lake(spark, target.name, target.format, batch_id=batch_id,
                             batch_column=batch_column).count()
        if target.kind == "path" and target.versioned:
            from tidewater.sources.lake import read_lake
            df = read_lake(spark, target.name, target.format)
        elif target.kind == "path":
            df = spark.read.format(target.format).load(target.name)
        else:
            df = spark.table(table_name(target))
        if batch_id is not None:
            df = df.where(qcol(batch_column) == F.lit(batch_id))
        return df.count()
    name = qualify(target.name, target.default_database, target.default_schema)
    q = f"SELECT COUNT(*) AS CNT FROM {name}"
    if batch_id is not None:
        q += f" WHERE {batch_column} = {sql_text(batch_id)}"
    if target.kind == "jdbc":
        from tidewater.sources.jdbc import read_jdbc
        opts = {k: v for k, v in target.options.items() if k != "url"}
        return int(read_jdbc(spark, target.options["url"], query=q, options=opts).first()[0])
    from tidewater.sources.connector import read_query
    return int(read_query(spark, target.format, target.options, q).first()[0])
