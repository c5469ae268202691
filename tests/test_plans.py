"""Plan shapes that the design relies on at scale, checked on explain output."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from tidewater.constants import BATCH_ID
from tidewater.operators import dedupe_by_hash
from tidewater.plans.prepare import prepare
from tidewater.sinks import write_lake
from tidewater.sources import read_lake

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def prepared(spark, table="lineitem", batch="1"):
    return prepare(spark.read.parquet(f"{SF}/{table}.parquet"), "K", batch, "me", "SRC",
                   run_ts="1998-01-01 00:00:00", as_of="1998-01-01 00:00:00")


def test_prepare_is_one_codegen_stage_without_shuffle(spark):
    p = plan(prepared(spark))
    assert "Exchange" not in p and "Sort " not in p
    assert len(set(re.findall(r"codegen id : (\d+)", p))) == 1
    assert p.count("sha2(") == 1
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_projection_prunes_scan(spark):
    p = plan(prepared(spark).select("L_ORDERKEY", "ETL_BATCH_ID"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in p


def test_filter_reaches_scan_through_prepare(spark):
    df = prepared(spark).where(F.col("L_ORDERKEY") < 100)
    assert re.search(r"PushedFilters: \[.*LessThan\(l_orderkey,100\)", plan(df))


def test_emptiness_probe_reads_no_columns(spark):
    # the gate's probe: Dataset.isEmpty() is select().limit(1) taken incrementally
    p = plan(prepared(spark).select().limit(1))
    assert "ReadSchema: struct<>" in p and "sha2(" not in p


def test_batch_read_lists_only_its_directory(spark, tmp_dir):
    for b in ("1", "2"):
        write_lake(prepared(spark, "customer", b), tmp_dir, "incremental")
    df = read_lake(spark, tmp_dir, batch_id="2")
    p = plan(df)
    assert f"{BATCH_ID}=2" in p and f"{BATCH_ID}=1" not in p
    assert dict(df.dtypes)[BATCH_ID] == "string" and df.columns[-1] == BATCH_ID


def test_dedupe_is_partial_then_final_aggregate(spark):
    df = prepared(spark).withColumn(BATCH_ID, F.lit("1"))
    p = plan(dedupe_by_hash(df, "K"), "extended")
    assert "partial_min" in p and p.count("Exchange hashpartitioning") == 1
    assert "Window" not in p


def test_changes_first_pass_has_no_payload(spark, tmp_dir):
    from tidewater.operators.changes import changes_between_batches
    for b in ("1", "2"):
        write_lake(prepared(spark, "customer", b), tmp_dir, "incremental")
    p = plan(changes_between_batches(tmp_dir, "1", "2", "K", ["C_CUSTKEY"]), "extended")
    physical = p[p.index("== Physical Plan =="):]
    assert "ReadSchema: struct<K:string,C_CUSTKEY:" in physical
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
    # the exchange under the first aggregate carries key, hash and side only
    first = re.findall(r"HashAggregate\(keys=\[([^]]*)\], functions=\[partial_max\(_side[^]]*\]",
                       physical)
    assert first and all("C_NAME" not in f for f in first)


def test_no_exchange_of_bucketed_history(spark):
    from tidewater.operators import dedupe_new_rows, keep_hashes
    spark.sql("DROP TABLE IF EXISTS kept_hashes")
    history = prepared(spark, "customer", "1")
    keep_hashes(history.where("C_CUSTKEY % 2 = 0"), "K", "kept_hashes", 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = dedupe_new_rows(spark.table("kept_hashes"), prepared(spark, "customer", "2"), "K")
        lines = plan(fresh, "simple").splitlines()
        assert fresh.count() == history.where("C_CUSTKEY % 2 = 1").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = next(i for i, x in enumerate(lines) if "kept_hashes" in x and "Scan" in x)
    join = max(i for i, x in enumerate(lines[:scan]) if "SortMergeJoin" in x)
    assert join < scan and not any("Exchange" in x for x in lines[scan - 3:scan])


def test_incremental_dedupe_reads_only_the_hash_of_history(spark, tmp_dir):
    from tidewater.operators import dedupe_new_rows
    write_lake(prepared(spark, "customer", "1"), tmp_dir, "incremental")
    history = read_lake(spark, tmp_dir, batch_id="1")
    new = prepared(spark, "customer", "2")
    p = plan(dedupe_new_rows(history, new, "K"))
    assert "ReadSchema: struct<K:string>" in p
    assert "LeftAnti" in p
