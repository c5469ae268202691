"""

Every query reads the given tables (whole, never a sample) and runs the
library's operators on Spark. Queries that exercise sinks write under the
session's shared ``spark.checkpoint.dir`` (a fresh directory per call) and
return a DataFrame that reads back what was written.

Pinned values make results repeatable: batch ids, ``run_ts`` and ``as_of``.
SHA-512 has no DuckDB counterpart, so oracle queries hash with SHA-256.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# The driver may load this file by path from another working directory.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidewater.constants import BATCH_ID  # noqa: E402
from tidewater.operators import (  # noqa: E402
    add_audit_columns, add_row_hash, dedupe_by_hash, load_gate, normalize_columns,
    sanitize_timestamps,
)
from tidewater.operators.changes import (  # noqa: E402
    changes_between_batches, detect_changes,
)
from tidewater.plans import RunConfig, Source, TableSpec, Target, ingest_all, summarize  # noqa: E402
from tidewater.plans.ingest import ingest_frame  # noqa: E402
from tidewater.plans.prepare import prepare  # noqa: E402
from tidewater.plans.session import scratch_dir  # noqa: E402
from tidewater.sinks import resolve_load, write_lake, write_target  # noqa: E402
from tidewater.sources import read_lake, target_exists  # noqa: E402
from tidewater.streaming import ingest_stream  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Pinned run values shared by the queries and their oracles.
CREATED_BY = "INGEST_JOB"
SOURCE_SYSTEM = "SRC"
RUN_TS = "1998-01-01 00:00:00"
AS_OF = "1998-01-01 00:00:00"
EVENTS_AS_OF = "2024-01-15 00:00:00"
B1, B2, B3 = "19980101000000", "19980102000000", "19980103000000"

# Column lists of the given tables (for the oracle SQL).
TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "labels": ["doc_id", "quality", "toxic"],
    "benchmark": ["item_id", "text"],
    "pages": ["page_id", "url", "html"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
HASHED_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "labels", "benchmark", "pages", "conversations"]
PREPARED_TABLES = {  # table -> as_of used for its timestamps
    "orders": AS_OF, "lineitem": AS_OF, "customer": AS_OF, "events": EVENTS_AS_OF,
    "region": AS_OF, "nation": AS_OF, "supplier": AS_OF, "part": AS_OF,
    "documents": AS_OF, "labels": AS_OF, "benchmark": AS_OF, "pages": AS_OF,
    "conversations": AS_OF,
}


def hash_key(table: str) -> str:
    return f"STG_{table.upper()}_KEY"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --------------------------------------------------------------------------
# Spark queries
# --------------------------------------------------------------------------

def q_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the full O1 transform of orders with the default SHA-512."""
    return prepare(_read(spark, sf_dir, "orders"), hash_key("orders"), B1, CREATED_BY,
                   SOURCE_SYSTEM, run_ts=RUN_TS, as_of=AS_OF, include_ntz=True)


def q_rename_customer(spark, sf_dir):
    return normalize_columns(_read(spark, sf_dir, "customer"))


RENAME_ALIASES = [("c_custkey", "CustKey"), ("c_custkey", "custKey"),
                  ("c_name", "customerName"), ("c_nationkey", "nationKey1"),
                  ("c_acctbal", "acctBAL"), ("c_mktsegment", "MKTSegment"),
                  ("c_name", "X"), ("c_name", "x"), ("c_acctbal", "x1")]


def q_rename_duplicates(spark, sf_dir):
    src = _read(spark, sf_dir, "customer")
    return normalize_columns(src.select(*[F.col(c).alias(a) for c, a in RENAME_ALIASES]))


def make_hash_query(table: str, bits: int, null_safe: bool = False):
    def q(spark, sf_dir):
        return add_row_hash(normalize_columns(_read(spark, sf_dir, table)),
                            hash_key(table), bits=bits, null_safe=null_safe)
    return q


def q_audit_orders(spark, sf_dir):
    return add_audit_columns(_read(spark, sf_dir, "orders"), B1, CREATED_BY,
                             SOURCE_SYSTEM, run_ts=RUN_TS)


def q_timestamps_orders(spark, sf_dir):
    return sanitize_timestamps(_read(spark, sf_dir, "orders"), as_of=AS_OF, include_ntz=True)


def q_timestamps_events(spark, sf_dir):
    return sanitize_timestamps(_read(spark, sf_dir, "events"), as_of=EVENTS_AS_OF,
                               include_ntz=True)


def q_timestamps_ltz_orders(spark, sf_dir):
    """Reference-faithful path: only zone-aware TIMESTAMP columns are checked."""
    src = _read(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return sanitize_timestamps(src, as_of=AS_OF)


def q_timestamps_ntz_skipped(spark, sf_dir):
    """Default: TIMESTAMP_NTZ columns are left alone."""
    return sanitize_timestamps(_read(spark, sf_dir, "orders"), as_of=AS_OF)


def q_etl_fill_orders(spark, sf_dir):
    src = _read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("ETL_SOURCE_DATE"),
        F.col("o_orderdate").alias("ORDER_DATE"))
    return sanitize_timestamps(src, as_of=AS_OF, include_ntz=True)


def make_prepare_query(table: str, as_of: str):
    def q(spark, sf_dir):
        return prepare(_read(spark, sf_dir, table), hash_key(table), B1, CREATED_BY,
                       SOURCE_SYSTEM, run_ts=as_of, as_of=as_of, bits=256,
                       include_ntz=True)
    return q


def _prepared(spark, sf_dir, table, batch, as_of=AS_OF, **kw):
    return prepare(_read(spark, sf_dir, table), hash_key(table), batch, CREATED_BY,
                   SOURCE_SYSTEM, run_ts=as_of, as_of=as_of, bits=256, **kw)


def q_hash512_orders(spark, sf_dir):
    return prepare(_read(spark, sf_dir, "orders"), hash_key("orders"), B1, CREATED_BY,
                   SOURCE_SYSTEM, run_ts=RUN_TS, as_of=AS_OF)


def q_gate(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    ready = load_gate(_prepared(spark, sf_dir, "orders", B1), hash_key("orders"),
                      "orders_prepared")
    raw = load_gate(normalize_columns(_read(spark, sf_dir, "customer")),
                    hash_key("customer"), "customer_raw")
    future = orders.where(F.col("o_orderdate") > F.lit("2100-01-01").cast("timestamp_ntz"))
    empty = load_gate(prepare(future, hash_key("orders"), B1, CREATED_BY, SOURCE_SYSTEM,
                              run_ts=RUN_TS, as_of=AS_OF, bits=256),
                      hash_key("orders"), "orders_future")
    return ready.unionByName(raw).unionByName(empty)


def q_append_roundtrip(spark, sf_dir):
    lake = scratch_dir(spark, "k1_append")
    for batch in (B1, B2, B2):  # the re-run of B2 replaces itself
        write_lake(_prepared(spark, sf_dir, "orders", batch), lake, "incremental", batch_id=batch)
    return read_lake(spark, lake)


def q_overwrite_roundtrip(spark, sf_dir):
    lake = scratch_dir(spark, "k1_overwrite")
    for batch in (B1, B2):
        write_lake(_prepared(spark, sf_dir, "orders", batch), lake, "historical", batch_id=batch)
    return read_lake(spark, lake)


def q_load_modes(spark, sf_dir):
    """K3 matrix on real loads: each mode against an existing and a missing
    target; the result is the row count per batch found in each target."""
    out = None
    for mode in ("historical", "incremental"):
        for existed in (True, False):
            target = Target(kind="path", name=scratch_dir(spark, "k3", mode))
            if existed:
                write_target(_prepared(spark, sf_dir, "customer", B1), target,
                             resolve_load(mode, False))
            exists = target_exists(spark, target)
            action = resolve_load(mode, exists)
            write_target(_prepared(spark, sf_dir, "customer", B2), target, action)
            kind = "create" if action.creates else ("replace" if action.replace else "append")
            counted = (read_lake(spark, target.name).groupBy(BATCH_ID)
                       .agg(F.count(F.lit(1)).alias("rows"))
                       .select(F.lit(mode).alias("mode"), F.lit(exists).alias("target_existed"),
                               F.lit(kind).alias("load_action"), BATCH_ID, "rows"))
            out = counted if out is None else out.unionByName(counted)
    return out


def q_source_count(spark, sf_dir):
    out = None
    for table in ("orders", "lineitem", "customer", "documents"):
        src = Source(kind="path", name=f"{sf_dir}/{table}.parquet")
        df = src.load(spark).agg(F.count(F.lit(1)).alias("total_count")).select(
            F.lit(table).alias("table_name"), "total_count")
        out = df if out is None else out.unionByName(df)
    return out


INGEST_TABLES = ["customer", "orders", "lineitem", "part", "supplier"]


def _ingest_report(spark, sf_dir):
    root = scratch_dir(spark, "o2")
    empty_view = "tidewater_orders_after_2100_" + root.rstrip("/").rsplit("/", 1)[-1]
    _read(spark, sf_dir, "orders").where(
        F.col("o_orderdate") > F.lit("2100-01-01").cast("timestamp_ntz")
    ).createOrReplaceTempView(empty_view)
    specs = [TableSpec(name=t, source=Source(kind="path", name=f"{sf_dir}/{t}.parquet"),
                       hash_column=hash_key(t), lake_path=f"{root}/lake/{t}",
                       target=Target(kind="path", name=f"{root}/target/{t}"))
             for t in INGEST_TABLES]
    specs.append(TableSpec(name="orders_after_2100", source=Source(kind="table", name=empty_view),
                           hash_column=hash_key("orders"), lake_path=f"{root}/lake/empty",
                           target=Target(kind="path", name=f"{root}/target/empty")))
    specs.append(TableSpec(name="missing", source=Source(kind="path",
                                                         name=f"{sf_dir}/no_such_table.parquet"),
                           hash_column="STG_MISSING_KEY", lake_path=f"{root}/lake/missing"))
    config = RunConfig(mode="historical", created_by=CREATED_BY, source_system=SOURCE_SYSTEM,
                       batch_id=B1, run_ts=RUN_TS, as_of=AS_OF, bits=256)
    return ingest_all(spark, specs, config)


def q_reconcile(spark, sf_dir):
    return _ingest_report(spark, sf_dir).select(
        "table_name", "status", "mode", "batch_id", "rows_in", "rows_landed",
        "rows_loaded", "ok", "load_action")


def q_reconcile_with_source_count(spark, sf_dir):
    """S3 + V3: the source count joins the reconciliation (incremental run)."""
    root = scratch_dir(spark, "s3v3")
    specs = [TableSpec(name=t, source=Source(kind="path", name=f"{sf_dir}/{t}.parquet"),
                       hash_column=hash_key(t), lake_path=f"{root}/lake/{t}",
                       target=Target(kind="path", name=f"{root}/target/{t}"))
             for t in ("orders", "lineitem")]
    config = RunConfig(mode="incremental", created_by=CREATED_BY, source_system=SOURCE_SYSTEM,
                       batch_id=B1, run_ts=RUN_TS, as_of=AS_OF, bits=256, count_source=True)
    return ingest_all(spark, specs, config).select(
        "table_name", "status", "rows_source", "rows_in", "rows_landed", "rows_loaded", "ok")


def q_summary(spark, sf_dir):
    # elapsed_s is wall time, not data: left out of the compared result
    return summarize(_ingest_report(spark, sf_dir)).drop("elapsed_s")


def q_dedupe_documents(spark, sf_dir):
    """Two incremental runs land the same snapshot twice; de-duplicating on
    a hash of ``text`` keeps one row per distinct text from the first batch."""
    lake = scratch_dir(spark, "x1")
    exclude = ("DOC_ID", "LANG", "SOURCE", "N_CHARS")
    for batch in (B1, B2):
        write_lake(_prepared(spark, sf_dir, "documents", batch, exclude=exclude), lake,
                   "incremental", batch_id=batch)
    return dedupe_by_hash(read_lake(spark, lake), hash_key("documents"))


def orders_snapshots(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of the orders source, both derived from the whole table.

    * before: as of 1999-01-01 - orders placed before then, and orders
      placed in the last six months still open;
    * after: today - everything, except finished orders placed before 1996,
      which the source has purged.
    """
    d = F.col("o_orderdate")
    before = orders.where(d < F.lit("1999-01-01").cast("timestamp_ntz")).withColumn(
        "o_orderstatus",
        F.when(d >= F.lit("1998-07-01").cast("timestamp_ntz"), F.lit("O"))
        .otherwise(F.col("o_orderstatus")))
    after = orders.where(~((F.col("o_orderstatus") == "F")
                           & (d < F.lit("1996-01-01").cast("timestamp_ntz"))))
    return before, after


def q_changed_orders(spark, sf_dir):
    lake = scratch_dir(spark, "x2")
    before, after = orders_snapshots(_read(spark, sf_dir, "orders"))
    for batch, snap in ((B1, before), (B2, after)):
        write_lake(prepare(snap, hash_key("orders"), batch, CREATED_BY, SOURCE_SYSTEM,
                           run_ts=RUN_TS, as_of=AS_OF, bits=256), lake, "incremental",
                   batch_id=batch)
    return changes_between_batches(read_lake(spark, lake), B1, B2, hash_key("orders"),
                                   ["O_ORDERKEY"])


def q_read_batch(spark, sf_dir):
    """S5: one batch of a two-batch lake, read from its own directory."""
    lake = scratch_dir(spark, "s5")
    for batch in (B1, B2):
        write_lake(_prepared(spark, sf_dir, "orders", batch), lake, "incremental", batch_id=batch)
    return read_lake(spark, lake, batch_id=B2)


def q_land_and_load(spark, sf_dir):
    """K5/O1: one table run; the target holds exactly the landed batch."""
    root = scratch_dir(spark, "k5")
    spec = TableSpec(name="orders", source=Source(kind="path", name=f"{sf_dir}/orders.parquet"),
                     hash_column=hash_key("orders"), lake_path=f"{root}/lake",
                     target=Target(kind="path", name=f"{root}/target"))
    config = RunConfig(mode="incremental", created_by=CREATED_BY, source_system=SOURCE_SYSTEM,
                       batch_id=B1, run_ts=RUN_TS, as_of=AS_OF, bits=256)
    from tidewater.plans.ingest import ingest_table
    row = ingest_table(spark, spec, config)
    if row["status"] != "success":
        raise RuntimeError(f"ingest failed: {row}")
    return read_lake(spark, f"{root}/target")


def _landed_snapshots(spark, sf_dir, name):
    lake = scratch_dir(spark, name)
    before, after = orders_snapshots(_read(spark, sf_dir, "orders"))
    for batch, snap in ((B1, before), (B2, after)):
        write_lake(prepare(snap, hash_key("orders"), batch, CREATED_BY, SOURCE_SYSTEM,
                           run_ts=RUN_TS, as_of=AS_OF, bits=256), lake, "incremental",
                   batch_id=batch)
    return read_lake(spark, lake)


def q_changed_orders_unkeyed(spark, sf_dir):
    """X2 without a business key: differences are new or removed rows."""
    return changes_between_batches(_landed_snapshots(spark, sf_dir, "x2u"), B1, B2,
                                   hash_key("orders"))


def q_dedupe_orders_snapshots(spark, sf_dir):
    """X1 over two different snapshots: every distinct row version once,
    from the batch where it first appeared."""
    return dedupe_by_hash(_landed_snapshots(spark, sf_dir, "x1o"), hash_key("orders"))


def _indexed_snapshots(spark, sf_dir, name, keys):
    """Both snapshots of orders in a lake whose batches have digests and filters."""
    from tidewater.sources.batch_index import index_batch
    lake = scratch_dir(spark, name)
    for batch, snap in zip((B1, B2), orders_snapshots(_read(spark, sf_dir, "orders")),
                           strict=True):
        write_lake(prepare(snap, hash_key("orders"), batch, CREATED_BY, SOURCE_SYSTEM,
                           run_ts=RUN_TS, as_of=AS_OF, bits=256), lake, "incremental",
                   batch_id=batch)
        index_batch(spark, lake, batch, hash_key("orders"), keys)
    return lake


def q_digest_changes(spark, sf_dir):
    """X2 by prefix digests: only rows of differing buckets are compared."""
    from tidewater.sources.batch_index import changes_of_batches
    lake = _indexed_snapshots(spark, sf_dir, "x2_digest", ["O_ORDERKEY"])
    return changes_of_batches(spark, lake, B1, B2, hash_key("orders"), ["O_ORDERKEY"])


def q_filtered_new_rows(spark, sf_dir):
    """Incremental X1 behind the first batch's membership filter."""
    from tidewater.sources.batch_index import new_rows_of_batch
    lake = _indexed_snapshots(spark, sf_dir, "x1_filter", ["O_ORDERKEY"])
    return new_rows_of_batch(spark, lake, B2, hash_key("orders"))


def q_dedupe_orders_incremental(spark, sf_dir):
    """Incremental X1: the de-duplicated table holds the first snapshot; the
    second batch contributes only row versions not seen before."""
    from tidewater.operators import dedupe_new_rows
    lake = _landed_snapshots(spark, sf_dir, "x1i")
    seen = dedupe_by_hash(lake.where(F.col(BATCH_ID) == B1), hash_key("orders"))
    return dedupe_new_rows(seen, lake.where(F.col(BATCH_ID) == B2), hash_key("orders"))


def q_stream_orders(spark, sf_dir):
    """Orders arrive as a file stream; each micro-batch is one incremental
    load batch (here: one epoch, since the source is one file)."""
    root = scratch_dir(spark, "stream")
    schema = _read(spark, sf_dir, "orders").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet")
              .parquet(sf_dir))
    spec = TableSpec(name="orders", source=Source(kind="path", name=f"{sf_dir}/orders.parquet"),
                     hash_column=hash_key("orders"), lake_path=f"{root}/lake",
                     target=Target(kind="path", name=f"{root}/target"))
    config = RunConfig(mode="incremental", created_by=CREATED_BY, source_system=SOURCE_SYSTEM,
                       run_ts=RUN_TS, as_of=AS_OF, bits=256)
    q = ingest_stream(stream, spec, config, f"{root}/checkpoint", "S",
                      report_path=f"{root}/report")
    q.awaitTermination()  # an available-now stream ends by itself
    return read_lake(spark, f"{root}/target")


def _table_run(spark, sf_dir, table, root, mode, batch, **config):
    """One whole table run into a path target; raises unless it succeeds."""
    from tidewater.plans.ingest import ingest_table
    spec = TableSpec(name=table, source=Source(kind="path", name=f"{sf_dir}/{table}.parquet"),
                     hash_column=hash_key(table), lake_path=f"{root}/lake/{table}",
                     target=Target(kind="path", name=f"{root}/target/{table}", versioned=True))
    run = RunConfig(mode=mode, created_by=CREATED_BY, source_system=SOURCE_SYSTEM, batch_id=batch,
                    run_ts=RUN_TS, as_of=AS_OF, bits=256, **config)
    row = ingest_table(spark, spec, run)
    if row["status"] != "success":
        raise RuntimeError(f"ingest failed: {row}")
    return spec, row


CONTENT_TABLES = ["customer", "orders", "lineitem", "documents"]


def q_content(spark, sf_dir):
    """V3: runs verified by content. Then one row of each target is changed, counts
    staying as they are, and the content is compared once more."""
    from concurrent.futures import ThreadPoolExecutor

    from tidewater.operators.checks import content_matches, content_of
    root = scratch_dir(spark, "v3_content")

    def checked(t: str) -> tuple:
        spec, row = _table_run(spark, sf_dir, t, root, "incremental", B1, verify="content")
        lake, target = read_lake(spark, spec.lake_path), read_lake(spark, spec.target.name)
        first = target.agg(F.min(hash_key(t))).first()[0]
        changed = target.withColumn("CREATED_BY", F.when(F.col(hash_key(t)) == first, F.lit("X"))
                                    .otherwise(F.col("CREATED_BY")))
        landed = content_of(lake)  # summed once for both comparisons
        return (t, row["status"], row["rows_in"], row["rows_loaded"],
                content_matches(landed, target), content_matches(landed, changed))

    # as in ingest_all: the jobs of small tables share the cluster with those of large ones
    with ThreadPoolExecutor(len(CONTENT_TABLES)) as pool:
        out = list(pool.map(checked, CONTENT_TABLES))
    return spark.createDataFrame(out, "table_name string, status string, rows_in long, "
                                      "rows_loaded long, same boolean, same_after_change boolean")


def q_publish(spark, sf_dir):
    """K5: a staged load that is not published changes nothing for readers."""
    from tidewater.sinks.lake import stage
    root = scratch_dir(spark, "k5_publish")
    spec, _ = _table_run(spark, sf_dir, "orders", root, "historical", B1)
    half = _prepared(spark, sf_dir, "orders", B2).where(F.col("O_ORDERKEY") % 2 == 0)
    for path in (spec.lake_path, spec.target.name):
        stage(half, path, "historical", batch_id=B2)
    return read_lake(spark, spec.target.name)


def q_manifest(spark, sf_dir):
    """K1: rows per batch in every version of a lake: two batches, one of them
    again, then all replaced at once."""
    from tidewater.sources.manifest import read_manifest
    lake, out = scratch_dir(spark, "k1_manifest"), None
    steps = [("incremental", B1, "orders"), ("incremental", B2, "orders"),
             ("incremental", B2, "orders"), ("historical", B3, "orders")]
    for mode, batch, table in steps:
        write_lake(_prepared(spark, sf_dir, table, batch), lake, mode, batch_id=batch)
        version = read_manifest(spark, lake).version
        counted = (read_lake(spark, lake, version=version).groupBy(BATCH_ID)
                   .agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(version).alias("version"), BATCH_ID, "rows"))
        # counted now: a later load may take the files of an old version away
        got = spark.createDataFrame(counted.collect(), counted.schema)
        out = got if out is None else out.unionByName(got)
    return out


def q_evolved_types(spark, sf_dir):
    """K1/S5: between two batches a column was renamed and two grew wider."""
    lake = scratch_dir(spark, "k1_types")
    orders = _read(spark, sf_dir, "orders")
    old = orders.select(F.col("o_orderkey").cast("int").alias("o_orderkey"),
                        F.col("o_custkey").alias("o_customer"),
                        F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"))
    new = orders.select(F.col("o_orderkey") + F.lit(2**40), "o_custkey",
                        F.col("o_totalprice").cast("decimal(14,2)").cast("decimal(16,4)"))
    new = new.toDF("o_orderkey", "o_custkey", "o_totalprice")
    for batch, df in ((B1, old), (B2, new)):
        write_lake(normalize_columns(df).withColumn(BATCH_ID, F.lit(batch)), lake, "incremental",
                   renames={"O_CUSTOMER": "O_CUSTKEY"}, batch_id=batch)
    return read_lake(spark, lake).withColumn("O_TOTALPRICE", F.col("O_TOTALPRICE").cast("string"))


def q_hash_nested(spark, sf_dir):
    """P6: a map built in either order hashes alike with ``canonical``."""
    o = _read(spark, sf_dir, "orders")
    status = [F.lit("status"), F.col("o_orderstatus")]
    priority = [F.lit("priority"), F.col("o_orderpriority")]
    tags = F.when(F.col("o_orderkey") % 2 == 0, F.create_map(*status, *priority)).otherwise(
        F.create_map(*priority, *status))
    hashed = add_row_hash(normalize_columns(o.select("o_orderkey", tags.alias("tags"))),
                          hash_key("orders"), bits=256, canonical=True)
    return hashed.select(hash_key("orders"), "O_ORDERKEY")


SPLITS = [("lineitem", "l_orderkey"), ("lineitem", "l_shipdate"), ("orders", "o_totalprice"),
          ("events", "user_id")]


def q_equal_depth(spark, sf_dir):
    """S1: equal-depth slices of skewed and even columns: every row lies in exactly
    one slice, and none has more than a quarter above its share."""
    from tidewater.sources import equal_depth_predicates
    out = []
    for table, column in SPLITS:
        df = _read(spark, sf_dir, table)
        clauses = equal_depth_predicates(df, column, 8)
        inside = df.select(*[F.coalesce(F.expr(c), F.lit(False)).cast("long").alias(f"s{i}")
                             for i, c in enumerate(clauses)])
        row = inside.agg(*[F.sum(c).alias(c) for c in inside.columns]).first()
        out.append((table, column, sum(row), max(row) * 8 <= 1.25 * sum(row)))
    return spark.createDataFrame(out, "table_name string, split_column string, rows long, "
                                      "even boolean")


def q_resumed(spark, sf_dir):
    """O2: a run over two tables, then a run of the same batch over five: the ledger
    says which are loaded already."""
    import dataclasses
    root = scratch_dir(spark, "o2_resume")
    specs = [TableSpec(name=t, source=Source(kind="path", name=f"{sf_dir}/{t}.parquet"),
                       hash_column=hash_key(t), lake_path=f"{root}/lake/{t}",
                       target=Target(kind="path", name=f"{root}/target/{t}"))
             for t in INGEST_TABLES]
    config = RunConfig(mode="incremental", created_by=CREATED_BY, source_system=SOURCE_SYSTEM,
                       batch_id=B1, run_ts=RUN_TS, as_of=AS_OF, bits=256, ledger=f"{root}/ledger")
    ingest_all(spark, specs[:2], config)
    again = [dataclasses.replace(s, source=Source(kind="path", name=f"{sf_dir}/gone.parquet"))
             for s in specs[:2]]  # what is loaded is not read again
    return ingest_all(spark, [*again, *specs[2:]], config).select(
        "table_name", "status", "reason", "rows_in", "rows_loaded")


def _with_extra(df: DataFrame) -> DataFrame:
    return df.withColumn("o_extra", F.col("o_orderkey") + 1)


def q_read_evolved(spark, sf_dir):
    """S5: batch 2 has a column more; the whole-lake read has it, NULL in batch 1."""
    lake = scratch_dir(spark, "s5_evolved")
    orders = _read(spark, sf_dir, "orders")
    for batch, src in ((B1, orders), (B2, _with_extra(orders))):
        write_lake(prepare(src, hash_key("orders"), batch, CREATED_BY, SOURCE_SYSTEM,
                           run_ts=AS_OF, as_of=AS_OF, bits=256), lake, "incremental",
                   batch_id=batch)
    return read_lake(spark, lake)


def q_catalog_evolve(spark, sf_dir):
    """K2: the same two batches through whole runs into a catalog table."""
    root = scratch_dir(spark, "k2_evolve")
    table = "tidewater_evolve_" + root.rsplit("/", 1)[1][:8]
    orders = _read(spark, sf_dir, "orders")
    for batch, src in ((B1, orders), (B2, _with_extra(orders))):
        spec = TableSpec(name="orders", source=Source(kind="table", name="unused"),
                         hash_column=hash_key("orders"), lake_path=f"{root}/lake",
                         target=Target(kind="table", name=table))
        config = RunConfig(mode="incremental", created_by=CREATED_BY, batch_id=batch,
                           source_system=SOURCE_SYSTEM, run_ts=AS_OF, as_of=AS_OF, bits=256,
                           time_zone=spark.conf.get("spark.sql.session.timeZone"))
        row = ingest_frame(spark, src, spec, config)
        if row["status"] != "success":
            raise RuntimeError(row["reason"])
    return spark.table(table)


def q_empty_rerun(spark, sf_dir):
    """K1: batch 2 is run again without rows; only batch 1 is left in the target."""
    root = scratch_dir(spark, "k1_empty")
    orders = _read(spark, sf_dir, "orders")
    for batch, src in ((B1, orders), (B2, orders), (B2, orders.where(F.lit(False)))):
        spec = TableSpec(name="orders", source=Source(kind="table", name="unused"),
                         hash_column=hash_key("orders"), lake_path=f"{root}/lake",
                         target=Target(kind="path", name=f"{root}/target"))
        config = RunConfig(mode="incremental", created_by=CREATED_BY, batch_id=batch,
                           source_system=SOURCE_SYSTEM, run_ts=AS_OF, as_of=AS_OF, bits=256,
                           time_zone=spark.conf.get("spark.sql.session.timeZone"))
        ingest_frame(spark, src, spec, config)
    return read_lake(spark, f"{root}/target")


def q_changed_text_hash(spark, sf_dir):
    """X2 where several rows share a hash: documents hashed by language and
    source alone; the later snapshot has lost one language."""
    docs = _read(spark, sf_dir, "documents")

    def snap(df):
        return add_row_hash(normalize_columns(df), "K", bits=256,
                            exclude=("DOC_ID", "TEXT", "N_CHARS")).drop("ETL_ROW_HASH")

    return detect_changes(snap(docs.where("source <> 'src1'")), snap(docs.where("lang <> 'de'")),
                          "K")


# --------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# --------------------------------------------------------------------------

def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _hash_sql(cols: list[tuple[str, str]]) -> str:
    """``cols``: (normalized name, SQL expression); hashed in name order."""
    parts = [f"coalesce(CAST({expr} AS VARCHAR), '')" for _, expr in sorted(cols)]
    if not parts:
        return "sha256('')"
    return "sha256(concat_ws('||', " + ", ".join(parts) + "))"


def _renamed(table: str) -> list[tuple[str, str]]:
    """Expected name and source column: the given tables are in lower snake case."""
    return [(c.upper(), c) for c in TABLE_COLUMNS[table]]


def _bad_ts(expr: str, as_of: str) -> str:
    year = int(as_of[:4])
    return (f"({expr} IS NULL OR year({expr}) < 1900 OR year({expr}) > {year + 1} "
            f"OR {expr} > TIMESTAMP {_lit(as_of)})")


def _clean_ts(expr: str, as_of: str, fill: bool = False) -> str:
    other = f"TIMESTAMP {_lit(as_of)}" if fill else "NULL"
    return f"CASE WHEN {_bad_ts(expr, as_of)} THEN {other} ELSE {expr} END"


def _audit_sql(batch: str, run_ts: str, as_of: str | None) -> str:
    ts = f"TIMESTAMP {_lit(run_ts)}"
    if as_of is not None:
        ts = _clean_ts(ts, as_of, fill=True)
    return (f"{ts} AS ETL_CREATED_DATE, {ts} AS ETL_LAST_UPDATE_DATE, "
            f"{_lit(CREATED_BY)} AS CREATED_BY, TRUE AS TO_PROCESS, "
            f"{_lit(SOURCE_SYSTEM)} AS EDW_EXTERNAL_SOURCE_SYSTEM, {_lit(batch)} AS ETL_BATCH_ID")


TS_COLUMNS = {"o_orderdate", "l_shipdate", "ts"}


def _prepare_sql(table: str, batch: str, as_of: str, exclude: tuple[str, ...] = (),
                 clean_ts: bool = True, where: str | None = None,
                 source: str | None = None) -> str:
    cols = _renamed(table)
    h = _hash_sql([(n, e) for n, e in cols if n not in exclude])
    body = []
    for n, e in cols:
        expr = _clean_ts(e, as_of) if (clean_ts and e in TS_COLUMNS) else e
        body.append(f"{expr} AS {n}")
    sql = (f"SELECT {h} AS {hash_key(table)}, {', '.join(body)}, {h} AS ETL_ROW_HASH, "
           f"{_audit_sql(batch, as_of, as_of)} FROM {source or table}")
    return sql + (f" WHERE {where}" if where else "")


def o_rename_customer() -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _renamed("customer")) + " FROM customer"


def o_rename_duplicates() -> str:
    names = ["CUST_KEY", "CUST_KEY_1", "CUSTOMER_NAME", "NATION_KEY_1", "ACCT_BAL", "MKT_SEGMENT",
             "X", "X_2", "X_1"]
    return ("SELECT " + ", ".join(f"{c} AS {n}" for (c, _), n in zip(RENAME_ALIASES, names))
            + " FROM customer")


def o_hash(table: str) -> str:
    cols = _renamed(table)
    h = _hash_sql(cols)
    return (f"SELECT {h} AS {hash_key(table)}, "
            + ", ".join(f"{e} AS {n}" for n, e in cols)
            + f", {h} AS ETL_ROW_HASH FROM {table}")


def o_hash_null_safe(table: str) -> str:
    cols = _renamed(table)
    fields = ", ".join(f'"{n}" := CAST({e} AS VARCHAR)' for n, e in sorted(cols))
    h = f"sha256(to_json(struct_pack({fields})))"
    return (f"SELECT {h} AS {hash_key(table)}, "
            + ", ".join(f"{e} AS {n}" for n, e in cols)
            + f", {h} AS ETL_ROW_HASH FROM {table}")


def o_audit_orders() -> str:
    return f"SELECT *, {_audit_sql(B1, RUN_TS, None)} FROM orders"


def _ts_select(table: str, as_of: str) -> str:
    body = [(_clean_ts(c, as_of) + f" AS {c}") if c in TS_COLUMNS else c
            for c in TABLE_COLUMNS[table]]
    return f"SELECT {', '.join(body)} FROM {table}"


def o_etl_fill_orders() -> str:
    return (f"SELECT o_orderkey, {_clean_ts('o_orderdate', AS_OF, fill=True)} AS ETL_SOURCE_DATE, "
            f"{_clean_ts('o_orderdate', AS_OF)} AS ORDER_DATE FROM orders")


def o_gate() -> str:
    missing = "missing audit columns: " + ",".join(sorted(
        ["CREATED_BY", "EDW_EXTERNAL_SOURCE_SYSTEM", "ETL_BATCH_ID", "ETL_CREATED_DATE",
         "ETL_LAST_UPDATE_DATE", "ETL_ROW_HASH", "TO_PROCESS"]))
    missing += f"; missing hash column: {hash_key('customer')}"
    future = "o_orderdate > TIMESTAMP '2100-01-01 00:00:00'"
    return f"""
        SELECT 'orders_prepared' AS table_name, count(*) > 0 AS ready,
               CASE WHEN count(*) = 0 THEN 'empty' ELSE '' END AS reasons FROM orders
        UNION ALL
        SELECT 'customer_raw', FALSE,
               CASE WHEN count(*) = 0 THEN 'empty; ' ELSE '' END || {_lit(missing)} FROM customer
        UNION ALL
        SELECT 'orders_future', count(*) > 0,
               CASE WHEN count(*) = 0 THEN 'empty' ELSE '' END FROM orders WHERE {future}"""


def o_append_roundtrip() -> str:
    return (_prepare_sql("orders", B1, AS_OF, clean_ts=False) + " UNION ALL "
            + _prepare_sql("orders", B2, AS_OF, clean_ts=False))


def o_overwrite_roundtrip() -> str:
    return _prepare_sql("orders", B2, AS_OF, clean_ts=False)


def o_load_modes() -> str:
    n = "(SELECT count(*) FROM customer)"
    rows = [("historical", True, "replace", B2), ("historical", False, "create", B2),
            ("incremental", True, "append", B1), ("incremental", True, "append", B2),
            ("incremental", False, "create", B2)]
    return " UNION ALL ".join(
        f"SELECT {_lit(m)} AS mode, {str(e).upper()} AS target_existed, {_lit(a)} AS load_action, "
        f"{_lit(b)} AS ETL_BATCH_ID, {n} AS rows" for m, e, a, b in rows)


def o_source_count() -> str:
    return " UNION ALL ".join(f"SELECT {_lit(t)} AS table_name, count(*) AS total_count FROM {t}"
                              for t in ("orders", "lineitem", "customer", "documents"))


def _report_rows_sql() -> str:
    parts = [f"SELECT {_lit(t)} AS table_name, 'success' AS status, 'historical' AS mode, "
             f"{_lit(B1)} AS batch_id, count(*) AS rows_in, count(*) AS rows_landed, "
             f"count(*) AS rows_loaded, TRUE AS ok, 'create' AS load_action FROM {t}"
             for t in INGEST_TABLES]
    parts.append("SELECT 'orders_after_2100', CASE WHEN count(*) = 0 THEN 'skipped' ELSE 'success' "
                 f"END, 'historical', {_lit(B1)}, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, "
                 "NULL::BOOLEAN, NULL::VARCHAR FROM orders "
                 "WHERE o_orderdate > TIMESTAMP '2100-01-01 00:00:00'")
    parts.append(f"SELECT 'missing', 'failed', 'historical', {_lit(B1)}, NULL::BIGINT, "
                 "NULL::BIGINT, NULL::BIGINT, NULL::BOOLEAN, NULL::VARCHAR")
    return " UNION ALL ".join(parts)


def o_reconcile() -> str:
    return _report_rows_sql()


def o_summary() -> str:
    return f"""
        SELECT count(*) AS tables,
               count(*) FILTER (WHERE status = 'success') AS succeeded,
               count(*) FILTER (WHERE status = 'failed') AS failed,
               count(*) FILTER (WHERE status = 'skipped') AS skipped,
               coalesce(string_agg(table_name, ',' ORDER BY table_name)
                        FILTER (WHERE status = 'failed'), '') AS failed_tables
        FROM ({_report_rows_sql()})"""


def o_dedupe_documents() -> str:
    exclude = ("DOC_ID", "LANG", "SOURCE", "N_CHARS")
    inner = _prepare_sql("documents", B1, AS_OF, exclude=exclude, clean_ts=False)
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {hash_key('documents')} ORDER BY DOC_ID) AS rn FROM ({inner})) "
            f"WHERE rn = 1")


_BEFORE_SRC = ("(SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP "
               "'1998-07-01 00:00:00' THEN 'O' ELSE o_orderstatus END AS o_orderstatus, "
               "o_totalprice, o_orderdate, o_orderpriority FROM orders "
               "WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00')")
_AFTER_SRC = ("(SELECT * FROM orders WHERE NOT (o_orderstatus = 'F' AND "
              "o_orderdate < TIMESTAMP '1996-01-01 00:00:00'))")


def o_changed_orders_unkeyed() -> str:
    cols = _renamed("orders")
    h = hash_key("orders")

    def snap(src):
        return (f"SELECT {_hash_sql(cols)} AS {h}, "
                + ", ".join(f"{e} AS {n}" for n, e in cols) + f" FROM {src}")

    return f"""
        WITH b AS ({snap(_BEFORE_SRC)}), a AS ({snap(_AFTER_SRC)})
        SELECT *, 'new' AS change FROM a WHERE {h} NOT IN (SELECT {h} FROM b)
        UNION ALL
        SELECT *, 'removed' FROM b WHERE {h} NOT IN (SELECT {h} FROM a)"""


def o_dedupe_orders_snapshots() -> str:
    h = hash_key("orders")
    landed = (_prepare_sql("orders", B1, AS_OF, clean_ts=False, source=_BEFORE_SRC)
              + " UNION ALL "
              + _prepare_sql("orders", B2, AS_OF, clean_ts=False, source=_AFTER_SRC))
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {h} "
            f"ORDER BY ETL_BATCH_ID, O_ORDERKEY) AS rn FROM ({landed})) WHERE rn = 1")


def o_changed_orders() -> str:
    cols = _renamed("orders")
    names = [n for n, _ in cols]
    h = hash_key("orders")

    def snap(src):
        return (f"SELECT {_hash_sql(cols)} AS {h}, "
                + ", ".join(f"{e} AS {n}" for n, e in cols) + f" FROM {src}")

    sel_a = ", ".join(f"a.{c}" for c in [h] + names)
    sel_b = ", ".join(f"b.{c}" for c in [h] + names)
    return f"""
        WITH b AS ({snap(_BEFORE_SRC)}), a AS ({snap(_AFTER_SRC)})
        SELECT {sel_a}, CASE WHEN b.O_ORDERKEY IS NULL THEN 'new' ELSE 'changed' END AS change
        FROM a LEFT JOIN b ON a.O_ORDERKEY = b.O_ORDERKEY
        WHERE b.O_ORDERKEY IS NULL OR a.{h} <> b.{h}
        UNION ALL
        SELECT {sel_b}, CASE WHEN a.O_ORDERKEY IS NULL THEN 'removed' ELSE 'replaced' END
        FROM b LEFT JOIN a ON a.O_ORDERKEY = b.O_ORDERKEY
        WHERE a.O_ORDERKEY IS NULL OR a.{h} <> b.{h}"""


def o_evolved_orders() -> str:
    more = _prepare_sql("orders", B2, AS_OF, clean_ts=False)
    cols = [*[(n, e) for n, e in _renamed("orders")], ("O_EXTRA", "o_orderkey + 1")]
    h = _hash_sql(cols)
    first = _prepare_sql("orders", B1, AS_OF, clean_ts=False)
    old = _hash_sql(_renamed("orders"))
    return (f"SELECT *, CAST(NULL AS BIGINT) AS O_EXTRA FROM ({first}) UNION ALL "
            + more.replace(old, h).replace(" FROM orders", ", o_orderkey + 1 AS O_EXTRA FROM orders"))


def o_changed_text_hash() -> str:
    h = "sha256(coalesce(lang, '') || '||' || coalesce(source, ''))"
    body = ", ".join(f"{c} AS {n}" for n, c in _renamed("documents"))
    snap = f"SELECT {h} AS K, {body} FROM documents WHERE "
    pick = ("(SELECT K, DOC_ID, TEXT, LANG, SOURCE, N_CHARS, {c} AS change FROM (SELECT *, "
            "row_number() OVER (PARTITION BY K ORDER BY doc_id) AS rn FROM {x}) "
            "WHERE rn = 1 AND K NOT IN (SELECT K FROM {y}))")
    return (f"WITH b AS ({snap} source <> 'src1'), a AS ({snap} lang <> 'de') "
            + pick.format(c="'new'", x="a", y="b") + " UNION ALL "
            + pick.format(c="'removed'", x="b", y="a"))


def o_content() -> str:
    return " UNION ALL ".join(
        f"SELECT {_lit(t)} AS table_name, 'success' AS status, count(*) AS rows_in, "
        f"count(*) AS rows_loaded, TRUE AS same, FALSE AS same_after_change FROM {t}"
        for t in CONTENT_TABLES)


def o_manifest() -> str:
    n = "(SELECT count(*) FROM orders)"
    rows = [(1, B1), (2, B1), (2, B2), (3, B1), (3, B2), (4, B3)]
    return " UNION ALL ".join(f"SELECT {v} AS version, {_lit(b)} AS ETL_BATCH_ID, {n} AS rows"
                              for v, b in rows)


def o_evolved_types() -> str:
    price = "CAST(CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(16,4)) AS VARCHAR)"
    return (f"SELECT o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY, {price} AS O_TOTALPRICE, "
            f"{_lit(B1)} AS ETL_BATCH_ID FROM orders UNION ALL SELECT o_orderkey + {2**40}, "
            f"o_custkey, {price}, {_lit(B2)} FROM orders")


def o_hash_nested() -> str:
    tags = ("'[{priority, ' || o_orderpriority || '}, {status, ' || o_orderstatus || '}]'")
    return (f"SELECT sha256(CAST(o_orderkey AS VARCHAR) || '||' || {tags}) AS {hash_key('orders')}, "
            "o_orderkey AS O_ORDERKEY FROM orders")


def o_equal_depth() -> str:
    return " UNION ALL ".join(
        f"SELECT {_lit(t)} AS table_name, {_lit(c)} AS split_column, count(*) AS rows, "
        f"TRUE AS even FROM {t}" for t, c in SPLITS)


def o_resumed() -> str:
    return " UNION ALL ".join(
        f"SELECT {_lit(t)} AS table_name, 'success' AS status, "
        f"{_lit('loaded by an earlier run') if i < 2 else 'NULL'} AS reason, "
        f"count(*) AS rows_in, count(*) AS rows_loaded FROM {t}"
        for i, t in enumerate(INGEST_TABLES))


# --------------------------------------------------------------------------
# Registry
# --------------------------------------------------------------------------

def _registry() -> dict[str, tuple[Callable, str | None]]:
    reg: dict[str, tuple[Callable, str | None]] = {
        "p2_rename_customer": (q_rename_customer, o_rename_customer()),
        "p2_rename_duplicates": (q_rename_duplicates, o_rename_duplicates()),
        "p6_hash512_orders": (q_hash512_orders, None),
        # array<float> text differs between engines: rows-only check
        "o1_prepare_embeddings": (make_prepare_query("embeddings", AS_OF), None),
        "p3_audit_orders": (q_audit_orders, o_audit_orders()),
        "f1_timestamps_orders": (q_timestamps_orders, _ts_select("orders", AS_OF)),
        "f1_timestamps_events": (q_timestamps_events, _ts_select("events", EVENTS_AS_OF)),
        "f1_timestamps_ltz_orders": (
            q_timestamps_ltz_orders,
            "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
            + _clean_ts("o_orderdate", AS_OF) + " AS o_orderdate, o_orderpriority FROM orders"),
        "f1_ntz_skipped_orders": (q_timestamps_ntz_skipped, "SELECT * FROM orders"),
        "f2_etl_fill_orders": (q_etl_fill_orders, o_etl_fill_orders()),
        "v1_gate": (q_gate, o_gate()),
        "k1_append_roundtrip": (q_append_roundtrip, o_append_roundtrip()),
        "k1_overwrite_roundtrip": (q_overwrite_roundtrip, o_overwrite_roundtrip()),
        "k3_modes": (q_load_modes, o_load_modes()),
        "v3_content": (q_content, o_content()),
        "k5_publish": (q_publish, _prepare_sql("orders", B1, AS_OF, clean_ts=False)),
        "k1_manifest": (q_manifest, o_manifest()),
        "k1_evolved_types": (q_evolved_types, o_evolved_types()),
        "p6_nested_orders": (q_hash_nested, o_hash_nested()),
        "s1_equal_depth": (q_equal_depth, o_equal_depth()),
        "o2_resumed": (q_resumed, o_resumed()),
        "s3_count": (q_source_count, o_source_count()),
        "v3_reconcile": (q_reconcile, o_reconcile()),
        "a4_summary": (q_summary, o_summary()),
        "v3_reconcile_source_count": (q_reconcile_with_source_count, " UNION ALL ".join(
            f"SELECT {_lit(t)} AS table_name, 'success' AS status, count(*) AS rows_source, "
            f"count(*) AS rows_in, count(*) AS rows_landed, count(*) AS rows_loaded, TRUE AS ok "
            f"FROM {t}" for t in ("orders", "lineitem"))),
        "x1_dedupe_documents": (q_dedupe_documents, o_dedupe_documents()),
        "x2_changed_orders": (q_changed_orders, o_changed_orders()),
        "s5_read_batch": (q_read_batch, _prepare_sql("orders", B2, AS_OF, clean_ts=False)),
        "k5_land_and_load_orders": (q_land_and_load,
                                    _prepare_sql("orders", B1, AS_OF, clean_ts=False)),
        "s5_read_evolved_orders": (q_read_evolved, o_evolved_orders()),
        "k2_catalog_evolve_orders": (q_catalog_evolve, o_evolved_orders()),
        "k1_empty_rerun_orders": (q_empty_rerun,
                                  _prepare_sql("orders", B1, AS_OF, clean_ts=False)),
        "x2_changed_documents_text_hash": (q_changed_text_hash, o_changed_text_hash()),
        "x2_changed_orders_unkeyed": (q_changed_orders_unkeyed, o_changed_orders_unkeyed()),
        "x1_dedupe_orders_snapshots": (q_dedupe_orders_snapshots, o_dedupe_orders_snapshots()),
        "x1_dedupe_orders_incremental": (
            q_dedupe_orders_incremental,
            f"SELECT * FROM ({o_dedupe_orders_snapshots()}) WHERE ETL_BATCH_ID = {_lit(B2)}"),
        "x1_filtered_orders": (
            q_filtered_new_rows,
            f"SELECT * FROM ({o_dedupe_orders_snapshots()}) WHERE ETL_BATCH_ID = {_lit(B2)}"),
        "x2_digest_orders": (q_digest_changes, o_changed_orders()),
        "stream_ingest_orders": (q_stream_orders, _prepare_sql(
            "orders", "S0000000000", AS_OF, clean_ts=False)),
    }
    for t in HASHED_TABLES:
        reg[f"p6_hash256_{t}"] = (make_hash_query(t, 256), o_hash(t))
    for t in ("orders", "customer"):
        reg[f"p6_nullsafe_{t}"] = (make_hash_query(t, 256, null_safe=True), o_hash_null_safe(t))
    for t, as_of in PREPARED_TABLES.items():
        reg[f"o1_prepare_{t}"] = (make_prepare_query(t, as_of), _prepare_sql(t, B1, as_of))
    return reg


def entry(spark: SparkSession) -> DataFrame:
    return q_entry(spark, SMOKE_DIR)


def _training_data() -> dict[str, tuple[Callable, str | None]]:
    """Queries of the optional training-data subpackage; none without it."""
    try:
        import corpus_pipeline
        from tidewater.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "tidewater.llm", "tidewater.llm.queries"):
            raise
        return {}
    found = {name: (fn, ORACLES.get(name)) for name, fn in QUERIES.items()}
    found["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in (_registry() | _training_data()).items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in (_registry() | _training_data()).items()
            if sql is not None}
