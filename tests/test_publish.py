"""Write, audit, publish: manifests, content checksums, renamed and widened columns."""

import dataclasses
import random
import threading

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_pipeline import cfg, spec
from tests.test_safety import rows
from tidewater.functions.content import content_metrics, content_text, row_digests
from tidewater.plans import Target
from tidewater.plans import ingest as ingest_module
from tidewater.plans.ingest import ingest_frame, ingest_table
from tidewater.sinks import lake as lake_module
from tidewater.sinks import resolve_load, write_lake, write_target
from tidewater.sinks import table as table_module
from tidewater.sinks.lake import discard, publish, stage, vacuum
from tidewater.sources import manifest as M
from tidewater.sources import read_lake


def batch(spark, b, n=5, **extra):
    return rows(spark, n, **extra).withColumn("ETL_BATCH_ID", F.lit(b))


def content(df):
    row = df.agg(*content_metrics(df.schema)).first()
    return content_text(row)


def ids(df):
    return sorted({r[0] for r in df.select("ETL_BATCH_ID").collect()})


# -- K1: manifest ----------------------------------------------------------

def test_readers_see_one_state_while_all_batches_are_replaced(spark, tmp_dir, monkeypatch):
    write_lake(batch(spark, "1"), tmp_dir, "incremental")
    write_lake(batch(spark, "2"), tmp_dir, "incremental")
    seen = []
    real = M.create_text

    def watched(*a):
        seen.append(ids(read_lake(spark, tmp_dir)))
        out = real(*a)
        seen.append(ids(read_lake(spark, tmp_dir)))
        return out

    before = read_lake(spark, tmp_dir)
    monkeypatch.setattr(M, "create_text", watched)
    write_lake(batch(spark, "3"), tmp_dir, "historical")
    assert seen == [["1", "2"], ["3"]]
    # what was resolved before the load is still there to be read
    assert ids(before) == ["1", "2"] and ids(read_lake(spark, tmp_dir, version=2)) == ["1", "2"]


def test_a_rerun_replaces_its_batch_and_old_directories_go(spark, tmp_dir):
    for n in (3, 4, 5, 6, 7):
        write_lake(batch(spark, "1", n), tmp_dir, "incremental")
        assert read_lake(spark, tmp_dir).count() == n
    assert len(M.versions(spark, tmp_dir)) <= M.KEPT_VERSIONS
    write_lake(batch(spark, "2", 2), tmp_dir, "incremental")
    staged = stage(batch(spark, "3"), tmp_dir, "incremental")
    vacuum(spark, tmp_dir)
    assert ids(read_lake(spark, tmp_dir)) == ["1", "2"] and len(M.versions(spark, tmp_dir)) == 1
    loads = M.list_names(spark, f"{tmp_dir}/{M.DATA_DIR}")
    assert len(loads) == 2 and f"_load={staged.load}" not in loads


def test_unpublished_loads_are_not_read(spark, tmp_dir):
    write_lake(batch(spark, "1"), tmp_dir, "incremental")
    staged = stage(batch(spark, "2"), tmp_dir, "historical")
    assert ids(read_lake(spark, tmp_dir)) == ["1"]
    with pytest.raises(ValueError, match="no batch '2'"):
        read_lake(spark, tmp_dir, batch_id="2")
    discard(spark, staged)
    assert ids(read_lake(spark, tmp_dir)) == ["1"]


def test_loads_published_side_by_side_keep_each_other(spark, tmp_dir):
    staged = [stage(batch(spark, str(b), b + 1), tmp_dir, "incremental") for b in range(6)]
    threads = [threading.Thread(target=publish, args=(spark, s, "incremental")) for s in staged]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert ids(read_lake(spark, tmp_dir)) == [str(b) for b in range(6)]
    assert read_lake(spark, tmp_dir).count() == 21


def test_a_commit_that_comes_second_is_applied_again(spark, tmp_dir, monkeypatch):
    write_lake(batch(spark, "1"), tmp_dir, "incremental")
    real, calls = M.create_text, []

    def beaten(spark_, path, text):
        if not calls:
            calls.append(path)
            rival = M.read_manifest(spark, tmp_dir)
            M_rival = dataclasses.replace(rival, version=rival.version + 1, batches={
                **rival.batches, "9": dataclasses.replace(rival.batches["1"])})
            assert real(spark_, path, M_rival.dump())
        return real(spark_, path, text)

    monkeypatch.setattr(M, "create_text", beaten)
    write_lake(batch(spark, "2"), tmp_dir, "incremental")
    assert sorted(M.read_manifest(spark, tmp_dir).batches) == ["1", "2", "9"]


def test_a_plain_lake_is_adopted(spark, tmp_dir):
    from tidewater.sources.lake import SCHEMA_DIR
    old = batch(spark, "1", x=1)
    old.write.mode("append").partitionBy("ETL_BATCH_ID").parquet(tmp_dir)
    spark.createDataFrame([(old.schema.json(),)], "value string").coalesce(1).write.text(
        f"{tmp_dir}/{SCHEMA_DIR}")
    assert read_lake(spark, tmp_dir).count() == 5
    write_lake(batch(spark, "2", 3, y="y"), tmp_dir, "incremental")
    got = read_lake(spark, tmp_dir)
    assert {(r["ETL_BATCH_ID"], r["x"], r["y"]) for r in got.collect()} == {
        ("1", 1, None), ("2", None, "y")}
    assert read_lake(spark, tmp_dir, batch_id="1").count() == 5
    write_lake(batch(spark, "3"), tmp_dir, "historical")
    assert ids(read_lake(spark, tmp_dir)) == ["3"]


# -- K1/S5: column ids and wider types --------------------------------------

def test_a_renamed_column_keeps_its_history(spark, tmp_dir):
    s = dataclasses.replace(spec(tmp_dir, "t", target=False), renames={"OLD": "NEW"})
    for b, df in (("1", rows(spark, old="a")), ("2", rows(spark, new="b")),
                  ("3", rows(spark, new="c", more=1))):
        assert ingest_frame(spark, df, s, cfg("incremental", b))["status"] == "success"
    got = read_lake(spark, s.lake_path)
    assert "OLD" not in got.columns
    assert {(r["ETL_BATCH_ID"], r["NEW"]) for r in got.collect()} == {
        ("1", "a"), ("2", "b"), ("3", "c")}
    M.rename_column(spark, s.lake_path, "NEW", "NEWER")
    assert {r["NEWER"] for r in read_lake(spark, s.lake_path).collect()} == {"a", "b", "c"}
    with pytest.raises(ValueError, match="already has"):
        M.rename_column(spark, s.lake_path, "NEWER", "MORE")
    file = read_lake(spark, s.lake_path, batch_id="2").inputFiles()[0]
    import pyarrow.parquet as pq
    field = pq.read_schema(file.removeprefix("file://")).field("NEW")
    assert field.metadata[b"PARQUET:field_id"] == str(
        next(M.field_id(f) for f in M.read_manifest(spark, s.lake_path).table.fields
             if f.name == "NEWER")).encode()


def test_wider_types_are_read_whole_and_narrower_ones_raise(spark, tmp_dir):
    def at(b, n, price, day):
        return (spark.range(1).select(
            F.lit(n).alias("n"), F.lit(price).alias("price"), F.lit(day).alias("day"))
            .withColumn("ETL_BATCH_ID", F.lit(b)))

    one = at("1", 7, 1, 1).select(F.col("n").cast("int"), F.lit("12.5").cast("decimal(5,2)")
                                  .alias("price"), F.lit("2024-01-01").cast("date").alias("day"),
                                  "ETL_BATCH_ID")
    two = at("2", 7, 1, 1).select(F.lit(2**40).alias("n"), F.lit("123456.125")
                                  .cast("decimal(12,3)").alias("price"),
                                  F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("day"),
                                  "ETL_BATCH_ID")
    write_lake(one, tmp_dir, "incremental")
    write_lake(two, tmp_dir, "incremental")
    got = read_lake(spark, tmp_dir)
    assert dict(got.dtypes) == {"n": "bigint", "price": "decimal(12,3)", "day": "timestamp_ntz",
                                "ETL_BATCH_ID": "string"}
    assert sorted((r["n"], str(r["price"]), str(r["day"])) for r in got.collect()) == [
        (7, "12.500", "2024-01-01 00:00:00"), (2**40, "123456.125", "2024-01-02 03:04:05")]
    assert dict(read_lake(spark, tmp_dir, batch_id="1").dtypes)["n"] == "bigint"
    with pytest.raises(ValueError, match="column type changed: n: bigint to int"):
        write_lake(one.withColumn("ETL_BATCH_ID", F.lit("3")), tmp_dir, "incremental")
    assert ids(got) == ["1", "2"]


@pytest.mark.parametrize("old,new,ok", [
    ("int", "bigint", True), ("bigint", "int", False), ("bigint", "double", False),
    ("int", "double", True), ("float", "double", True), ("smallint", "decimal(7,2)", True),
    ("int", "decimal(10,2)", False), ("decimal(5,2)", "decimal(6,3)", True),
    ("decimal(5,2)", "decimal(5,3)", False), ("date", "timestamp_ntz", True),
    ("string", "int", False), ("array<int>", "array<bigint>", True),
    ("struct<a:int>", "struct<a:bigint>", True), ("struct<a:int>", "struct<b:int>", False)])
def test_widening_order(spark, old, new, ok):
    kinds = [T.StructType.fromDDL(f"c {x}")[0].dataType for x in (old, new)]
    assert M.wider(*kinds) is ok


# -- V3: content ------------------------------------------------------------

def test_content_ignores_order_and_sees_every_change(spark):
    r = random.Random(4)
    data = [(i % 7, r.choice(["a", "b", None]), float(i % 3), {"x": i % 2, "y": 1}, [i % 2, None])
            for i in range(60)]
    kind = "a int, b string, c double, d map<string,int>, e array<int>"
    base = spark.createDataFrame(data, kind)
    want = content(base)
    shuffled = [(a, b, -0.0 if c == 0 else c, dict(reversed(d.items())), e)
                for a, b, c, d, e in data]
    r.shuffle(shuffled)
    assert content(spark.createDataFrame(shuffled, kind).repartition(7).select(
        "e", "d", "c", "b", "a")) == want
    for i in range(0, 60, 13):
        for changed in ((99, *data[i][1:]), (data[i][0], "z", *data[i][2:]),
                        (*data[i][:4], [None, None])):
            assert content(spark.createDataFrame([*data[:i], changed, *data[i + 1:]], kind)) != want
    # a pair of equal changes does not cancel out, nor do NULLs of two columns swap
    assert content(spark.createDataFrame([*data, data[0], data[0]], kind)) != want
    two = spark.createDataFrame([("x", None)], "a string, b string")
    assert content(two) != content(two.select(F.col("b").alias("a"), F.col("a").alias("b")))


@pytest.mark.parametrize("kind", ["path", "versioned", "table"])
def test_equal_counts_with_one_changed_row_fail(spark, tmp_dir, monkeypatch, kind):
    s = spec(tmp_dir, "customer")
    if kind == "versioned":
        s = dataclasses.replace(s, target=dataclasses.replace(s.target, versioned=True))
    if kind == "table":
        spark.sql("DROP TABLE IF EXISTS publish_content")
        s = dataclasses.replace(s, target=Target(kind="table", name="publish_content"))
    check = dataclasses.replace(cfg("incremental", "1"), verify="content")
    row = ingest_table(spark, s, check)
    assert row["status"] == "success" and ":" in row["content"], row
    counted = dataclasses.replace(cfg("incremental", "2"), verify="content")
    broken = {"path": "stage_target", "versioned": "stage_target", "table": "write_target"}[kind]
    real = getattr(ingest_module, broken)

    def corrupt(df, *a, **k):
        return real(df.withColumn("C_NAME", F.when(F.col("C_CUSTKEY") == 3, "X")
                                  .otherwise(F.col("C_NAME"))), *a, **k)

    monkeypatch.setattr(ingest_module, broken, corrupt)
    row = ingest_table(spark, s, counted)
    assert row["status"] == "failed" and row["ok"] is False
    assert row["reason"] == "loaded rows differ from the landed ones"
    assert row["rows_loaded"] == row["rows_landed"] == row["rows_in"]
    if kind != "table":  # not published: readers have the old rows
        found = (read_lake(spark, s.target.name) if kind == "versioned"
                 else spark.read.parquet(s.target.name))
        assert {str(r[0]) for r in found.select("ETL_BATCH_ID").collect()} == {"1"}
    monkeypatch.undo()
    assert ingest_table(spark, s, counted)["status"] == "success"


# -- K5: write, audit, publish ----------------------------------------------

def test_a_load_that_fails_its_audit_stays_hidden(spark, tmp_dir, monkeypatch):
    s = spec(tmp_dir, "customer")
    assert ingest_table(spark, s, cfg("historical", "1"))["status"] == "success"
    n = read_lake(spark, s.lake_path).count()
    real = ingest_module.read_staged
    monkeypatch.setattr(ingest_module, "read_staged", lambda *a: real(*a).where("C_CUSTKEY > 1"))
    for mode in ("historical", "incremental"):
        row = ingest_table(spark, s, cfg(mode, "2"))
        assert row["status"] == "failed" and row["reason"] == "row counts disagree"
    monkeypatch.undo()
    real_stage = ingest_module.stage_target
    monkeypatch.setattr(ingest_module, "stage_target",
                        lambda df, *a: real_stage(df.where("C_CUSTKEY > 1"), *a))
    row = ingest_table(spark, s, cfg("historical", "3"))
    assert row["status"] == "failed" and row["reason"] == "row counts disagree"
    found = spark.read.parquet(s.target.name)
    assert found.count() == n and {str(r[0]) for r in found.select("ETL_BATCH_ID").collect()} == {"1"}
    monkeypatch.undo()
    assert ids(read_lake(spark, s.lake_path)) == ["3"]  # landed and audited before
    assert ingest_table(spark, s, cfg("historical", "4"))["status"] == "success"


def test_a_first_load_that_fails_leaves_no_target(spark, tmp_dir, monkeypatch):
    s = spec(tmp_dir, "customer")
    real = ingest_module.stage_target
    monkeypatch.setattr(ingest_module, "stage_target",
                        lambda df, *a: real(df.where("C_CUSTKEY > 1"), *a))
    assert ingest_table(spark, s, cfg())["status"] == "failed"
    monkeypatch.undo()
    row = ingest_table(spark, s, cfg())
    assert row["status"] == "success" and row["load_action"] == "create"


def test_a_publish_that_breaks_half_way_is_undone(spark, tmp_dir, monkeypatch):
    t = Target(kind="path", name=f"{tmp_dir}/t")
    for b in ("1", "2"):
        write_target(batch(spark, b), t, resolve_load("incremental", b != "1"))
    real, calls = table_module.move, []

    def breaks(spark_, a, b):
        calls.append(a)
        if len(calls) == 3:
            raise OSError("no more space")
        real(spark_, a, b)

    monkeypatch.setattr(table_module, "move", breaks)
    with pytest.raises(OSError, match="no more space"):
        write_target(batch(spark, "3"), t, resolve_load("historical", True))
    got = spark.read.parquet(t.name)
    assert {str(r[0]) for r in got.select("ETL_BATCH_ID").collect()} == {"1", "2"}


def test_versioned_target_evolves(spark, tmp_dir):
    s = spec(tmp_dir, "t")
    s = dataclasses.replace(s, target=dataclasses.replace(s.target, versioned=True))
    for b, df in (("1", rows(spark).withColumn("n", F.lit(1))),
                  ("2", rows(spark).withColumn("n", F.lit(2**40)))):
        assert ingest_frame(spark, df, s, cfg("incremental", b))["status"] == "success"
    got = read_lake(spark, s.target.name)
    assert {r["N"] for r in got.collect()} == {1, 2**40}
    row = ingest_frame(spark, rows(spark, 0), s, cfg("incremental", "2"))
    assert row["status"] == "skipped" and ids(read_lake(spark, s.target.name)) == ["1"]


# -- K2: threads ------------------------------------------------------------

def test_two_historical_loads_in_a_dynamic_session_both_replace(spark, tmp_dir):
    names = ["publish_threads_a", "publish_threads_b"]
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        write_target(batch(spark, "1"), Target(kind="table", name=name),
                     resolve_load("incremental", False), "1")
    key, modes = "spark.sql.sources.partitionOverwriteMode", []
    spark.conf.set(key, "dynamic")
    errors = []

    def load(name):
        try:
            for b in ("2", "3", "4"):
                write_target(batch(spark, b), Target(kind="table", name=name),
                             resolve_load("historical", True), b)
                modes.append(spark.conf.get(key))
        except Exception as exc:  # shown by the assertion below
            errors.append(exc)

    try:
        threads = [threading.Thread(target=load, args=(n,)) for n in names]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    finally:
        spark.conf.set(key, "static")
    assert not errors and set(modes) == {"dynamic"}
    for name in names:
        assert ids(spark.table(name)) == ["4"]
        spark.sql(f"DROP TABLE {name}")


def test_plain_layouts_are_still_written_in_place(spark, tmp_dir):
    df = batch(spark, "1")
    assert write_lake(df, f"{tmp_dir}/csv", "incremental", fmt="csv") == 5
    assert write_lake(df, f"{tmp_dir}/flat", "historical", partition_by=()) == 5
    assert spark.read.parquet(f"{tmp_dir}/flat").count() == 5
    assert not lake_module.versioned("csv") and lake_module.versioned("orc")


# -- loads of one known batch ------------------------------------------------

@pytest.mark.parametrize("versioned", [False, True])
def test_loads_of_one_batch_are_not_sorted_by_it(spark, tmp_dir, monkeypatch, versioned):
    written, real = [], DataFrameWriter.save

    def watched(self, *a, **k):
        written.append(self._df)
        return real(self, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "save", watched)
    s = spec(tmp_dir, "customer")
    s = dataclasses.replace(s, target=dataclasses.replace(s.target, versioned=versioned))
    for verify in ("counts", "content"):
        assert ingest_table(spark, s, dataclasses.replace(
            cfg("incremental", "1"), verify=verify))["status"] == "success"
    assert len(written) == 4
    for df in written:  # the order Spark asks for before it writes partitions
        plan = df.sortWithinPartitions("ETL_BATCH_ID")._jdf.queryExecution().optimizedPlan()
        assert "Sort" not in plan.toString()


def test_a_known_batch_holds_no_other_rows(spark, tmp_dir):
    two = batch(spark, "1", 3).unionByName(batch(spark, "2", 2))
    for wrong in (two, batch(spark, "1").withColumn("ETL_BATCH_ID", F.lit(None).cast("string"))):
        with pytest.raises(ValueError, match="not of batch '1'"):
            write_lake(wrong, tmp_dir, "incremental", batch_id="1")
    assert M.read_manifest(spark, tmp_dir) is None
    assert write_lake(batch(spark, "1").where(F.lit(False)), tmp_dir, "incremental",
                      batch_id="1") == 0
    assert write_lake(batch(spark, "1"), tmp_dir, "incremental", batch_id="1") == 5
    assert write_lake(two, tmp_dir, "incremental") == 5
    assert sorted(tuple(r) for r in read_lake(spark, tmp_dir).collect()) == sorted(
        tuple(r) for r in two.select(*read_lake(spark, tmp_dir).columns).collect())


def test_content_sums_are_those_of_the_hashes(spark):
    df = spark.range(200).select("id", F.col("id").cast("string").alias("s"))
    hashes = df.select(*row_digests(df.schema)).collect()
    assert content(df) == ":".join(str(sum(h[i] for h in hashes)) for i in (0, 1))
    assert "decimal" not in df.agg(*content_metrics(df.schema)).schema.simpleString()
