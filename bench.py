"""Benchmark the headline operators; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 BENCH_REPEATS=3 python bench.py

Each query runs once to warm up, then ``BENCH_REPEATS`` times; the median
wall time is reported. Ingest queries reload into the same scratch lake and
target on every repeat (historical mode replaces them), so the scratch space
used stays at one copy per query. Transform-only queries end in the ``noop`` sink, so
every column is computed but nothing is written; ingest queries really
write parquet to a fresh scratch directory.

``ingest_lineitem_reread`` runs the same transform with the reference's
action pattern (source count, extracted count, two emptiness probes, two
sinks each re-reading the source, read-back counts) for comparison with
``ingest_lineitem`` (land once, load the target from the landed batch).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidewater.operators import add_row_hash, dedupe_by_hash  # noqa: E402
from tidewater.operators.changes import changes_between_batches  # noqa: E402
from tidewater.plans import RunConfig, Source, TableSpec, Target, ingest_all  # noqa: E402
from tidewater.plans.ingest import ingest_table  # noqa: E402
from tidewater.plans.prepare import prepare  # noqa: E402
from tidewater.plans.session import scratch_dir, session_conf  # noqa: E402
from tidewater.sinks import resolve_load, write_lake, write_target  # noqa: E402
from tidewater.sources import read_lake, target_exists  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
RUN_TS = "1998-01-01 00:00:00"


def session() -> SparkSession:
    b = (SparkSession.builder.master(f"local[{CPUS}]").appName("tidewater-bench")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.files.maxPartitionBytes", str(32 * 1024 * 1024)))
    for k, v in session_conf(shuffle_partitions=CPUS * 2).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_ROOTS: dict[str, str] = {}


def root_for(spark, name: str) -> str:
    """One scratch root per query and process: repeats reload into the same
    lake and target (historical mode replaces them), so disk use does not
    grow with the number of repeats."""
    if name not in _ROOTS:
        _ROOTS[name] = scratch_dir(spark, "bench", name)
    return _ROOTS[name]


def read(spark, table):
    return spark.read.parquet(f"{SF_DIR}/{table}.parquet")


def prep(df, table, batch="1", **kw):
    return prepare(df, f"STG_{table.upper()}_KEY", batch, "BENCH", "SRC", run_ts=RUN_TS,
                   as_of=RUN_TS, **kw)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def config(mode="historical", batch="1"):
    return RunConfig(mode=mode, created_by="BENCH", source_system="SRC", batch_id=batch,
                     run_ts=RUN_TS, as_of=RUN_TS)


def q_prepare_lineitem(spark):
    noop(prep(read(spark, "lineitem"), "lineitem"))


def q_prepare_orders(spark):
    noop(prep(read(spark, "orders"), "orders"))


def q_hash_documents(spark):
    noop(add_row_hash(read(spark, "documents"), "STG_DOCUMENTS_KEY"))


def q_ingest_lineitem(spark):
    root = root_for(spark, "ingest_lineitem")
    spec = TableSpec(name="lineitem", source=Source(kind="path", name=f"{SF_DIR}/lineitem.parquet"),
                     hash_column="STG_LINEITEM_KEY", lake_path=f"{root}/lake",
                     target=Target(kind="path", name=f"{root}/wh"))
    row = ingest_table(spark, spec, config())
    assert row["status"] == "success", row


def q_ingest_lineitem_spread(spark):
    """``ingest_lineitem`` with ``spread=CPUS``: the source file is one row
    group (one task), as an unpartitioned JDBC read would be."""
    root = root_for(spark, "ingest_lineitem_spread")
    spec = TableSpec(name="lineitem", source=Source(kind="path", name=f"{SF_DIR}/lineitem.parquet"),
                     hash_column="STG_LINEITEM_KEY", lake_path=f"{root}/lake",
                     target=Target(kind="path", name=f"{root}/wh"), spread=CPUS)
    row = ingest_table(spark, spec, config())
    assert row["status"] == "success", row


def q_ingest_lineitem_reread(spark):
    """Same transform and sinks, the reference's action pattern."""
    root = root_for(spark, "ingest_lineitem_reread")
    src = Source(kind="path", name=f"{SF_DIR}/lineitem.parquet")
    assert src.count_rows(spark) > 0                       # source count
    df = prep(src.load(spark), "lineitem")
    df.count()                                             # extracted count
    if not df.isEmpty():                                   # lake emptiness probe
        write_lake(df, f"{root}/lake", "historical")       # lake sink, re-reads source
        read_lake(spark, f"{root}/lake").count()           # lake read-back count
    if not df.isEmpty():                                   # gate emptiness probe
        df.count()                                         # to-be-loaded count
        t = Target(kind="path", name=f"{root}/wh")
        write_target(df, t, resolve_load("historical", target_exists(spark, t)))
        spark.read.parquet(f"{root}/wh").count()           # target count


def q_ingest_all_tpch(spark):
    root = root_for(spark, "ingest_all_tpch")
    tables = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    specs = [TableSpec(name=t, source=Source(kind="path", name=f"{SF_DIR}/{t}.parquet"),
                       hash_column=f"STG_{t.upper()}_KEY", lake_path=f"{root}/lake/{t}",
                       target=Target(kind="path", name=f"{root}/wh/{t}")) for t in tables]
    rep = ingest_all(spark, specs, config())
    assert rep.where(F.col("status") != "success").isEmpty()


def setup_documents_twice(spark):
    lake = scratch_dir(spark, "bench")
    for b in ("1", "2"):
        write_lake(prep(read(spark, "documents"), "documents", b), lake, "incremental")
    return lake


def q_dedupe_documents(spark, lake):
    """X1 alone, over two landed batches of documents."""
    noop(dedupe_by_hash(read_lake(spark, lake), "STG_DOCUMENTS_KEY"))


def setup_lineitem_snapshots(spark):
    lake = scratch_dir(spark, "bench")
    li = read(spark, "lineitem")
    before = li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")).withColumn(
        "l_linestatus", F.lit("O"))
    after = li.where(F.col("l_returnflag") != "R")
    write_lake(prep(before, "lineitem", "1"), lake, "incremental")
    write_lake(prep(after, "lineitem", "2"), lake, "incremental")
    return lake


def q_changes_lineitem(spark, lake):
    """X2 alone, between two landed lineitem snapshots."""
    noop(changes_between_batches(lake, "1", "2", "STG_LINEITEM_KEY",
                                 ["L_ORDERKEY", "L_LINENUMBER"]))


QUERIES = {
    "prepare_lineitem": q_prepare_lineitem,
    "prepare_orders": q_prepare_orders,
    "hash_documents": q_hash_documents,
    "ingest_lineitem": q_ingest_lineitem,
    "ingest_lineitem_reread": q_ingest_lineitem_reread,
    "ingest_lineitem_spread": q_ingest_lineitem_spread,
    "ingest_all_tpch": q_ingest_all_tpch,
    "dedupe_documents": (setup_documents_twice, q_dedupe_documents),
    "changes_lineitem": (setup_lineitem_snapshots, q_changes_lineitem),
}


def main() -> None:
    spark = session()
    picks = sys.argv[1:]
    times = {}
    for name, entry in QUERIES.items():
        if picks and name not in picks:
            continue
        if isinstance(entry, tuple):  # (untimed setup, timed run)
            setup, run = entry
            state = setup(spark)
            fn = lambda s, _run=run, _state=state: _run(s, _state)
        else:
            fn = entry
        fn(spark)  # warm-up
        runs = []
        for _ in range(REPEATS):
            t0 = time.perf_counter()
            fn(spark)
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    # comparison variants are reported but not summed into the headline
    headline = [k for k in times if k not in ("ingest_lineitem_reread", "ingest_lineitem_spread")]
    total = round(sum(times[k] for k in headline), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_median_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": CPUS, "repeats": REPEATS}))


if __name__ == "__main__":
    main()
