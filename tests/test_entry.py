"""The driver contract in __spark_entry__.py, checked at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_oracles_are_a_subset_of_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in q if n != "pipeline" and not n.startswith("op")}
    assert own - set(o) == {"p6_hash512_orders", "o1_prepare_embeddings"}


def test_entry_is_stable(spark):
    a = E.entry(spark)
    rows = a.collect()
    assert len(rows) > 0 and a.columns[0] == "STG_ORDERS_KEY"
    assert sorted(map(tuple, rows)) == sorted(map(tuple, E.entry(spark).collect()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["o1_prepare_orders", "p2_rename_duplicates",
                                  "f1_timestamps_events", "v1_gate", "k3_modes",
                                  "x2_changed_orders", "x1_dedupe_orders_incremental"])
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.sql(E.oracle_sql()[name]).df()
    assert digest(got) == digest(want)


def _run(args, env_extra=None):
    import json
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, **(env_extra or {})}
    proc = subprocess.run([sys.executable, *args], cwd=root, env=env, capture_output=True,
                          text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-3000:]
    return proc.stdout, json


def test_bench_prints_one_json_line():
    out, json = _run(["bench.py", "hash_documents"],
                     {"BENCH_SF_DIR": SF, "BENCH_REPEATS": "1", "BENCH_CPUS": "2"})
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and rec["sf"] == "0.001" and "hash_documents" in rec["queries"]


def test_plans_script_runs():
    out, _ = _run(["scripts/plans.py", SF])
    assert out.count("== Physical Plan ==") == 6
