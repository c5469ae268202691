"""Resumed runs, equal-depth splits, hashes of nested columns."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_pipeline import SF, cfg, spec
from tidewater.operators import add_row_hash
from tidewater.plans import Source, ingest_all
from tidewater.plans import ingest as ingest_module
from tidewater.plans.config import specs_from_dict
from tidewater.sources import equal_depth_predicates, jdbc


# -- O2: ledger --------------------------------------------------------------

def test_a_restarted_run_loads_what_is_missing(spark, tmp_dir, monkeypatch):
    specs = [spec(tmp_dir, t) for t in ("region", "nation", "customer")]
    run = dataclasses.replace(cfg("incremental", "7"), ledger=f"{tmp_dir}/ledger", max_in_flight=1)
    real, loaded = ingest_module.ingest_table, []

    def killed(spark_, s, c):
        if len(loaded) == 2:
            raise KeyboardInterrupt
        loaded.append(s.name)
        return real(spark_, s, c)

    monkeypatch.setattr(ingest_module, "ingest_table", killed)
    with pytest.raises(KeyboardInterrupt):
        ingest_all(spark, specs, run)
    assert loaded == ["region", "nation"]

    def counted(spark_, s, c):
        loaded.append(s.name)
        return real(spark_, s, c)

    monkeypatch.setattr(ingest_module, "ingest_table", counted)
    report = ingest_all(spark, specs, run).collect()
    assert loaded == ["region", "nation", "customer"]
    assert [r["status"] for r in report] == ["success"] * 3
    assert [r["reason"] for r in report] == ["loaded by an earlier run"] * 2 + [None]
    assert [r["rows_loaded"] for r in report] == [
        spark.read.parquet(f"{SF}/{s.name}.parquet").count() for s in specs]
    # another batch, or another target, is other work
    ingest_all(spark, specs[:1], dataclasses.replace(run, batch_id="8"))
    elsewhere = dataclasses.replace(specs[0], target=dataclasses.replace(
        specs[0].target, name=f"{tmp_dir}/elsewhere"))
    ingest_all(spark, [elsewhere], run)
    assert loaded[3:] == ["region", "region"]


def test_a_failed_table_is_loaded_again(spark, tmp_dir):
    bad = spec(tmp_dir, "nope", source=Source(kind="path", name=f"{SF}/nope.parquet"))
    run = dataclasses.replace(cfg("incremental", "7"), ledger=f"{tmp_dir}/ledger")
    assert ingest_all(spark, [bad], run).first()["status"] == "failed"
    good = dataclasses.replace(bad, source=Source(kind="path", name=f"{SF}/region.parquet"))
    row = ingest_all(spark, [good], run).first()
    assert row["status"] == "success" and row["reason"] is None


# -- S1: equal-depth splits ----------------------------------------------------

def _slices(df, clauses):
    counts = [df.where(c).count() for c in clauses]
    assert sum(counts) == df.count()
    return counts


def test_skewed_keys_fall_into_even_slices(spark):
    # nine rows in ten have ids below 100, the others reach up to a million
    df = spark.range(2000).select(F.when(F.col("id") % 10 < 9, F.col("id") % 100)
                                  .otherwise(F.col("id") * 500).alias("k"))
    clauses = equal_depth_predicates(df, "k", 8)
    counts = _slices(df, clauses)
    assert len(clauses) >= 8 and max(counts) <= 1.2 * 2000 / 8
    even = (999_500 // 8) + 1
    assert df.where(f"k < {even}").count() > 1700  # what slices of equal width would do


def test_heavy_values_and_nulls(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 600, 7).when(F.col("id") < 650, None)
                                  .otherwise(F.col("id")).cast("double").alias("k"))
    df = df.unionByName(spark.sql("SELECT double('NaN') AS k"))
    clauses = equal_depth_predicates(df.where("not isnan(k) or k is null"), "k", 5)
    counts = _slices(df.where("not isnan(k) or k is null"), clauses)
    assert sorted(counts)[-1] == 600 and sorted(counts)[-2] <= 200
    one = spark.range(5).select(F.lit(3).alias("k"))
    assert _slices(one, equal_depth_predicates(one, "k", 4)) == [5]
    assert len(equal_depth_predicates(one.where("k > 3"), "k", 4)) == 1
    assert len(equal_depth_predicates(one, "k", 1)) == 1


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(12,2)"])
def test_bounds_of_every_kind(spark, kind):
    df = spark.range(400).select((F.lit("2024-01-01").cast("timestamp_ntz")
                                  + F.make_dt_interval(hours="id") if "d" == kind[0] and "dec"
                                  not in kind or "time" in kind else F.col("id") / 4)
                                 .cast(kind).alias("k"))
    clauses = equal_depth_predicates(df, "k", 4)
    assert max(_slices(df, clauses)) <= 130 and len(clauses) == 4


def test_text_is_refused(spark):
    with pytest.raises(ValueError, match="order it otherwise"):
        equal_depth_predicates(spark.createDataFrame([("a",)], "k string"), "k", 4)


def test_clauses_reach_the_reader(spark, monkeypatch):
    seen = []

    def read(spark_, url, query=None, table=None, options=None, partitioning=None,
             predicates=None):
        seen.append((query, partitioning, predicates))
        if query.startswith("SELECT MIN"):
            return spark.createDataFrame([(0, 99)], "lo int, hi int")
        return spark.range(100).select(F.col("id").alias("id"))

    monkeypatch.setattr(jdbc, "read_jdbc", read)
    source = Source(kind="jdbc", name="dbo.t", options={"url": "u"}, partition_column="id",
                    partitions=4, split="depth", split_sample="TABLESAMPLE (5 PERCENT)")
    source.load(spark)
    assert seen[1][0] == "SELECT id FROM dbo.t TABLESAMPLE (5 PERCENT)"
    assert seen[1][1].options()["numPartitions"] == "4"
    assert seen[2][0] == "SELECT * FROM dbo.t" and len(seen[2][2]) == 4
    assert seen[2][1] is None and seen[2][2][0].endswith("OR id IS NULL")
    assert jdbc._bound(dt.datetime(2024, 1, 2, 3, 4, 5, 6)) == "'2024-01-02 03:04:05.000006'"
    with pytest.raises(ValueError, match="split must be"):
        Source(kind="jdbc", name="t", split="odd")
    specs, run = specs_from_dict({
        "mode": "incremental", "created_by": "a", "source_system": "b", "ledger": "/l",
        "verify": "content", "canonical": True, "tables": [{
            "name": "t", "hash_column": "K", "lake_path": "/x", "renames": {"A": "B"},
            "source": {"kind": "jdbc", "name": "t", "options": {}, "partition_column": "id",
                       "partitions": 3, "split": "depth"},
            "target": {"kind": "path", "name": "/y", "versioned": True}}]})
    assert (run.ledger, run.verify, run.canonical) == ("/l", "content", True)
    assert specs[0].source.split == "depth" and specs[0].renames == {"A": "B"}
    assert specs[0].target.versioned


# -- P6: nested columns --------------------------------------------------------

def test_equal_maps_in_unlike_order_hash_alike(spark):
    kind = "a int, m map<string,array<map<int,double>>>, s struct<x:map<string,int>,y:float>"
    left = spark.createDataFrame([(1, {"p": [{1: 0.0, 2: 1.5}], "q": None}, ({"u": 1, "v": 2}, 0.0))],
                                 kind)
    right = spark.createDataFrame([(1, {"q": None, "p": [{2: 1.5, 1: -0.0}]}, ({"v": 2, "u": 1}, -0.0))],
                                  kind)
    def digest(df, **k):
        return add_row_hash(df, "K", **k).first()["K"]

    assert digest(left, canonical=True) == digest(right, canonical=True)
    assert digest(left, canonical=True, null_safe=True) == digest(right, canonical=True, null_safe=True)
    assert digest(left) != digest(right)
    other = left.withColumn("m", F.create_map(F.lit("p"), F.col("m")["p"], F.lit("r"), F.col("m")["q"]))
    assert digest(left, canonical=True) != digest(other, canonical=True)


def test_flat_columns_keep_their_bytes(spark):
    for t in ("orders", "customer", "documents"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        assert (add_row_hash(df, "K", canonical=True).select("K")
                .exceptAll(add_row_hash(df, "K").select("K")).isEmpty())


def test_map_column_in_a_whole_run(spark, tmp_dir):
    from tidewater.plans.ingest import ingest_frame
    from tidewater.sources import read_lake
    s = spec(tmp_dir, "t")
    run = dataclasses.replace(cfg("incremental", "1"), canonical=True, verify="content")
    df = spark.range(4).select("id", F.when(F.col("id") % 2 == 0, F.create_map(
        F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))).otherwise(F.create_map(
            F.lit("b"), F.lit(2), F.lit("a"), F.lit(1))).alias("m"), F.lit(1).alias("same"))
    s = dataclasses.replace(s, exclude=("ID",))
    assert ingest_frame(spark, df, s, run)["status"] == "success"
    assert read_lake(spark, s.lake_path).select("STG_T_KEY").distinct().count() == 1
