"""X1 and X2 against brute-force models on small fixtures, including a hot
key that holds a third of all rows."""

import random

import pandas as pd
from pyspark.sql import functions as F

from tidewater.constants import BATCH_ID
from tidewater.operators import add_row_hash, dedupe_by_hash, detect_changes

SF = "/root/testdata/sf0.001"


def brute_dedupe(pdf, key, order):
    rest = [c for c in pdf.columns if c != key and c not in order]
    out = pdf.sort_values(order + rest, kind="mergesort").groupby(key, as_index=False).head(1)
    return sorted(map(tuple, out[pdf.columns].itertuples(index=False)))


def test_dedupe_matches_brute_force_with_hot_key(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        hot = i % 3 == 0  # a third of all rows share one hash
        h = "hot" if hot else f"h{rng.randrange(60)}"
        rows.append((h, f"b{rng.randrange(4)}", rng.randrange(1000), f"v{rng.randrange(5)}"))
    df = spark.createDataFrame(rows, f"H string, {BATCH_ID} string, N int, V string")
    got = sorted(map(tuple, dedupe_by_hash(df, "H").collect()))
    want = brute_dedupe(pd.DataFrame(rows, columns=df.columns), "H", [BATCH_ID])
    assert got == want


def test_dedupe_keeps_earliest_batch(spark):
    df = spark.createDataFrame([("h", "2", 1), ("h", "1", 9), ("g", "3", 5)],
                               f"H string, {BATCH_ID} string, N int")
    got = {r["H"]: (r[BATCH_ID], r["N"]) for r in dedupe_by_hash(df, "H").collect()}
    assert got == {"h": ("1", 9), "g": ("3", 5)}
    assert dedupe_by_hash(df, "H").columns == df.columns


def test_dedupe_plan_has_partial_aggregate(spark):
    df = spark.createDataFrame([("h", "1", 1)], f"H string, {BATCH_ID} string, N int")
    plan = dedupe_by_hash(df, "H")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert "Window" not in plan


def brute_changes(prev, cur, key):
    pk = {r[key] for r in prev}
    ck = {r[key] for r in cur}
    ph = {r["H"] for r in prev}
    chh = {r["H"] for r in cur}
    out = set()
    for r in cur:
        if r["H"] not in ph:
            out.add((r[key], r["H"], "changed" if r[key] in pk else "new"))
    for r in prev:
        if r["H"] not in chh:
            out.add((r[key], r["H"], "replaced" if r[key] in ck else "removed"))
    return out


def test_changes_match_brute_force_with_hot_key(spark):
    rng = random.Random(11)

    def snapshot(n):
        rows = []
        for i in range(n):
            k = 0 if i % 3 == 0 else rng.randrange(40)  # key 0 holds a third
            rows.append({"K": k, "V": f"v{rng.randrange(6)}"})
        return rows

    prev, cur = snapshot(300), snapshot(300)
    sp = add_row_hash(spark.createDataFrame(prev, "K int, V string"), "H")
    sc = add_row_hash(spark.createDataFrame(cur, "K int, V string"), "H")
    prev_h = [r.asDict() for r in sp.collect()]
    cur_h = [r.asDict() for r in sc.collect()]
    got = {(r["K"], r["H"], r["change"]) for r in
           detect_changes(sp.drop("ETL_ROW_HASH"), sc.drop("ETL_ROW_HASH"), "H", ["K"]).collect()}
    assert got == brute_changes(prev_h, cur_h, "K")


def test_changes_without_keys_and_null_keys(spark):
    prev = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "K int, V string")
    cur = spark.createDataFrame([(None, "a2"), (1, "b"), (3, "d")], "K int, V string")
    p, c = add_row_hash(prev, "H").drop("ETL_ROW_HASH"), add_row_hash(cur, "H").drop("ETL_ROW_HASH")
    keyed = {(r["K"], r["V"], r["change"]) for r in detect_changes(p, c, "H", ["K"]).collect()}
    assert keyed == {(None, "a2", "changed"), (None, "a", "replaced"), (3, "d", "new"),
                     (2, "c", "removed")}
    plain = {(r["V"], r["change"]) for r in detect_changes(p, c, "H").collect()}
    assert plain == {("a2", "new"), ("d", "new"), ("a", "removed"), ("c", "removed")}


def test_changes_plan_never_joins_snapshots(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = add_row_hash(o, "H").drop("ETL_ROW_HASH")
    plan = detect_changes(p, p, "H", ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    # one aggregate over the union, one presence aggregate, one join with the presence table
    assert "Union" in plan and "partial_max" in plan


def test_incremental_dedupe_equals_full_dedupe(spark):
    from tidewater.operators import dedupe_new_rows
    rng = random.Random(3)
    rows = [(("hot" if i % 3 == 0 else f"h{rng.randrange(80)}"), f"b{i % 3}", rng.randrange(50))
            for i in range(450)]
    df = spark.createDataFrame(rows, f"H string, {BATCH_ID} string, N int")
    full = sorted(map(tuple, dedupe_by_hash(df, "H").collect()))
    state = dedupe_by_hash(df.where(f"{BATCH_ID} = 'b0'"), "H")
    for b in ("b1", "b2"):
        new = dedupe_new_rows(state, df.where(f"{BATCH_ID} = '{b}'"), "H")
        state = state.unionByName(new)
    assert sorted(map(tuple, state.collect())) == full


def test_changes_between_landed_batches_by_path_with_added_column(spark, tmp_dir):
    from tidewater.operators.changes import changes_between_batches
    from tidewater.plans.prepare import prepare
    from tidewater.sinks import write_lake
    o = spark.read.parquet(f"{SF}/orders.parquet")
    prev = o.where("o_orderkey < 1000")
    cur = o.where("o_orderkey >= 10").withColumn("o_note", F.lit("n"))  # column added
    for b, snap in (("1", prev), ("2", cur)):
        write_lake(prepare(snap, "K", b, "me", "SRC"), tmp_dir, "incremental")
    got = changes_between_batches(tmp_dir, "1", "2", "K", ["O_ORDERKEY"])
    counts = dict(got.groupBy("change").count().collect())
    n_prev, n_cur = prev.count(), cur.count()
    both = o.where("o_orderkey >= 10 and o_orderkey < 1000").count()
    # every common key changed: its hash now covers the new column
    assert counts == {"removed": n_prev - both, "replaced": both, "changed": both,
                      "new": n_cur - both}
    assert "O_NOTE" in got.columns


def test_payload_does_not_depend_on_row_order_and_dropped_columns_stay(spark):
    from tidewater.operators import detect_changes
    prev = spark.createDataFrame([("h1", 5, "x", "old"), ("h1", 2, "y", "old"), ("h2", 1, "z", "o")],
                                 "H string, A int, B string, GONE string")
    cur = spark.createDataFrame([("h2", 1, "z", 7), ("h3", 9, "q", 7), ("h3", 3, "q", 8)],
                                "H string, A int, B string, FRESH int")
    want = {("h1", 2, "y", None, "old", "removed"), ("h3", 3, "q", 8, None, "new")}
    for p, c in ((prev, cur), (prev.repartition(3), cur.orderBy("A"))):
        out = detect_changes(p, c, "H")
        assert out.columns == ["H", "A", "B", "FRESH", "GONE", "change"]
        assert {tuple(r) for r in out.collect()} == want


def test_map_columns_and_null_or_odd_hashes(spark):
    from tidewater.operators import dedupe_by_hash, detect_changes
    prev = spark.sql("SELECT 'ab' AS H, map('k', 1) AS m UNION ALL SELECT 'AB', map('k', 2) "
                     "UNION ALL SELECT NULL, map('n', 1)")
    cur = spark.sql("SELECT 'ab' AS H, map('k', 1) AS m UNION ALL SELECT 'not hex', map('k', 3)")
    got = {(r["H"], r["change"]) for r in detect_changes(prev, cur, "H").collect()}
    assert got == {("AB", "removed"), (None, "removed"), ("not hex", "new")}
    assert dedupe_by_hash(prev.unionByName(prev), "H", ()).count() == 3
