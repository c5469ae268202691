"""Digests and filters beside batches: same rows as the plain plans, less read."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import add_row_hash, dedupe_new_rows
from tidewater.operators import digests as D
from tidewater.operators.changes import changes_between_batches
from tidewater.sinks import write_lake
from tidewater.sources import batch_index, read_lake
from tidewater.sources import manifest as M
from tidewater.sources.batch_index import changes_of_batches, index_batch, new_rows_of_batch


def snapshot(spark, data, batch, kind="int"):
    df = spark.createDataFrame(data, f"K {kind}, V string")
    return add_row_hash(df, "H").withColumn("ETL_BATCH_ID", F.lit(batch))


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def versions(n, seed, every):
    """Two snapshots: a hot key, repeated rows and NULL keys; one row in ``every`` differs."""
    rng = random.Random(seed)
    prev = [(0 if i % 3 == 0 else None if i % 101 == 0 else i, f"v{i}") for i in range(n)]
    prev += prev[:20]
    cur = [(k, v + "x") if rng.randrange(every) == 0 else (k, v) for k, v in prev
           if rng.randrange(every) != 1] + [(10**6 + i, "new") for i in range(n // every)]
    return prev, cur


@pytest.fixture()
def lake(spark, tmp_dir):
    path = f"{tmp_dir}/lake"
    for b, data in zip(("1", "2"), versions(3000, 5, 100), strict=True):
        write_lake(snapshot(spark, data, b), path, "incremental")
    return path


@pytest.mark.parametrize("keys", [["K"], []])
def test_changes_are_those_of_the_plain_plan(spark, lake, keys):
    want = rows_of(changes_between_batches(lake, "1", "2", "H", keys))
    assert rows_of(changes_of_batches(spark, lake, "1", "2", "H", keys)) == want  # no index yet
    for b in ("1", "2"):
        index_batch(spark, lake, b, "H", keys)
    assert rows_of(changes_of_batches(spark, lake, "1", "2", "H", keys)) == want
    assert rows_of(changes_of_batches(spark, lake, "1", "2", "H", keys, max_broadcast=3)) == want
    assert len(want) > 50
    assert read_lake(spark, lake).count() == sum(map(len, versions(3000, 5, 100)))


def test_only_rows_of_differing_buckets_leave_the_scan(spark, tmp_dir):
    path, n = f"{tmp_dir}/lake", 4000
    prev = [(i, f"v{i}") for i in range(n)]
    cur = [(k, "other" if k % 100 == 7 else v) for k, v in prev]  # 1 % of the rows
    for b, data in (("1", prev), ("2", cur)):
        write_lake(snapshot(spark, data, b), path, "incremental")
        index_batch(spark, path, b, "H", ["K"])
    found = M.read_manifest(spark, path)
    depth = {batch_index._entry(found, b, "digest", "H", ["K"])["depth"] for b in ("1", "2")}
    assert depth == {D.depth_for(n, D.ROWS_PER_BUCKET)}
    changes = changes_of_batches(spark, path, "1", "2", "H", ["K"])
    assert changes.count() == 2 * n // 100
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2  # below the union, on each side
    side = batch_index._in_buckets
    kept = []
    batch_index._in_buckets = lambda *a: kept.append(side(*a)) or kept[-1]
    try:
        changes_of_batches(spark, path, "1", "2", "H", ["K"])
    finally:
        batch_index._in_buckets = side
    left = kept[0].count()
    assert n // 100 <= left < n // 5
    physical = kept[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical and "hashpartitioning" not in physical


def test_equal_batches_are_not_read(spark, tmp_dir):
    path, data = f"{tmp_dir}/lake", [(i, f"v{i}") for i in range(500)]
    for b, rows in (("1", data), ("2", data[::-1])):
        write_lake(snapshot(spark, rows, b), path, "incremental")
        index_batch(spark, path, b, "H", ["K"])
    same = changes_of_batches(spark, path, "1", "2", "H", ["K"])
    assert "FileScan" not in same._jdf.queryExecution().executedPlan().toString()
    assert same.count() == 0


def test_batches_of_unlike_size_are_folded(spark, tmp_dir):
    path = f"{tmp_dir}/lake"
    for b, n in (("1", 40), ("2", 3000)):
        write_lake(snapshot(spark, [(i, f"v{i}") for i in range(n)], b), path, "incremental")
        index_batch(spark, path, b, "H", ["K"])
    assert changes_of_batches(spark, path, "1", "2", "H", ["K"]).count() == 2960
    assert changes_of_batches(spark, path, "2", "1", "H", ["K"]).count() == 2960


def test_a_filter_holds_all_it_was_given_and_few_others(spark):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("H"))
    other = spark.range(5000, 25000).select(F.sha2(F.col("id").cast("string"), 256).alias("H"))
    depth = D.depth_for(5000, D.ROWS_PER_BLOCK)
    held = D.hash_filter(df, "H", depth)
    assert D.possible_hits(df, "H", held, depth).count() == 5000
    assert D.possible_hits(other, "H", held, depth).count() < 400
    halves = [(D.hash_filter(df.where("H < '8'"), "H", depth), depth),
              (D.hash_filter(df.where("H >= '8'"), "H", depth + 2), depth + 2)]
    merged, at = D.merge_filters(halves)
    assert at == depth and sorted(merged.collect()) == sorted(held.collect())


def new_plain(spark, lake, batch):
    every = read_lake(spark, lake)
    return rows_of(dedupe_new_rows(every.where(F.col("ETL_BATCH_ID") < batch),
                                   every.where(F.col("ETL_BATCH_ID") == batch), "H"))


def test_new_rows_are_those_of_the_plain_plan(spark, lake):
    extra = [(5, "v5"), (7, "only here"), (7, "only here"), (None, "v101")]
    write_lake(snapshot(spark, extra, "3"), lake, "incremental")
    for b in ("2", "3"):
        want = new_plain(spark, lake, b)
        assert rows_of(new_rows_of_batch(spark, lake, b, "H")) == want
        index_batch(spark, lake, "1", "H", ["K"])  # for "3": one batch with a filter, one without
        assert rows_of(new_rows_of_batch(spark, lake, b, "H")) == want
    index_batch(spark, lake, "2", "H", ["K"])
    assert rows_of(new_rows_of_batch(spark, lake, "3", "H")) == want
    assert rows_of(new_rows_of_batch(spark, lake, "3", "H", max_broadcast=0)) == want
    assert "only here" in "".join(want)


def test_a_batch_without_possible_hits_reads_no_history(spark, tmp_dir):
    path = f"{tmp_dir}/lake"
    for b in ("1", "2"):
        write_lake(snapshot(spark, [(i, f"{b} {i}") for i in range(20)], b), path, "incremental")
        index_batch(spark, path, b, "H")
    # far fewer rows than bits: the one row below meets no set bit
    fresh = new_rows_of_batch(spark, path, "2", "H")
    assert fresh.count() == 20
    write_lake(snapshot(spark, [(1, "third")], "3"), path, "incremental")
    got = new_rows_of_batch(spark, path, "3", "H")
    assert got.count() == 1
    files = "".join(got.inputFiles())
    assert "ETL_BATCH_ID=3" in files and "ETL_BATCH_ID=1" not in files


def test_an_index_goes_with_its_batch_and_its_types(spark, tmp_dir):
    path, data = f"{tmp_dir}/lake", [(i, f"v{i}") for i in range(100)]
    for b in ("1", "2"):
        write_lake(snapshot(spark, data, b), path, "incremental")
        index_batch(spark, path, b, "H", ["K"])
    M.rename_column(spark, path, "K", "KEY")  # columns are known by id
    found = M.read_manifest(spark, path)
    assert batch_index._entry(found, "1", "digest", "H", ["KEY"])
    M.rename_column(spark, path, "KEY", "K")
    write_lake(snapshot(spark, data[:-1], "2", "long"), path, "incremental")
    found = M.read_manifest(spark, path)
    assert not found.batches["2"].index  # replaced
    assert batch_index._entry(found, "1", "digest", "H", ["K"]) is None  # wider key
    got = changes_of_batches(spark, path, "1", "2", "H", ["K"]).collect()
    assert [(r["K"], r["change"]) for r in got] == [(99, "removed")]
    with pytest.raises(ValueError):
        index_batch(spark, path, "9", "H")


def test_an_empty_side(spark):
    none = spark.createDataFrame([], "K int, H string")
    some = spark.createDataFrame([(1, "a"), (None, None)], "K int, H string")
    unlike, _ = D.differing_buckets(D.prefix_digests(none, "H", ["K"], 3), 3,
                                    D.prefix_digests(some, "H", ["K"], 5), 5)
    assert unlike.count() in (1, 2)
    same, _ = D.differing_buckets(D.prefix_digests(some, "H", ["K"], 0), 0,
                                  D.prefix_digests(some, "H", ["K"], 5), 5)
    assert same.count() == 0
