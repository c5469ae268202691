"""No load loses or hides data: columns, old rows, other tools' directories."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from tests.test_pipeline import cfg, spec
from tests.test_sinks import prepared
from tidewater.plans import RunConfig, Source, Target, ingest_all
from tidewater.plans.config import specs_from_dict
from tidewater.plans.ingest import ingest_frame, ingest_table
from tidewater.plans.session import check_zone, scratch_dir
from tidewater.sinks import resolve_load, write_lake, write_target
from tidewater.sources import read_lake, target_exists
from tidewater.sources.lake import stored_schema


def rows(spark, n=5, **extra):
    df = spark.range(n).withColumnRenamed("id", "a")
    for k, v in extra.items():
        df = df.withColumn(k, F.lit(v))
    return df


@pytest.mark.parametrize("name", ["_delta_log", "_keep"])
def test_a_foreign_directory_is_not_missing(spark, tmp_dir, name):
    s = spec(tmp_dir, "customer")
    os.makedirs(f"{s.target.name}/{name}")
    open(f"{s.target.name}/{name}/x.json", "w").write("{}")
    for mode in ("incremental", "historical"):
        row = ingest_table(spark, s, cfg(mode))
        assert row["status"] == "failed" and "is not empty" in row["reason"]
    assert os.listdir(f"{s.target.name}/{name}") == ["x.json"]
    os.makedirs(f"{tmp_dir}/nothing")
    assert not target_exists(spark, Target(kind="path", name=f"{tmp_dir}/nothing"))


def test_an_empty_historical_write_changes_nothing(spark, tmp_dir):
    df = prepared(spark, "1")
    n = write_lake(df, tmp_dir, "historical")
    assert write_lake(df.where(F.lit(False)), tmp_dir, "historical") == 0
    assert read_lake(spark, tmp_dir).count() == n


def test_an_empty_rerun_removes_the_batch(spark, tmp_dir):
    s = spec(tmp_dir, "t")
    for b in ("1", "2"):
        assert ingest_frame(spark, rows(spark), s, cfg("incremental", b))["status"] == "success"
    row = ingest_frame(spark, rows(spark, 0), s, cfg("incremental", "2"))
    assert row["status"] == "skipped" and row["reason"] == "empty; earlier rows of the batch removed"
    for path in (s.lake_path, s.target.name):
        assert [r[0] for r in read_lake(spark, path).select("ETL_BATCH_ID").distinct().collect()
                ] == ["1"]
    assert ingest_frame(spark, rows(spark, 0), s, cfg("incremental", "3"))["reason"] == "empty"


def test_a_failing_reload_keeps_the_old_rows(spark, tmp_dir):
    n = write_lake(prepared(spark, "1"), tmp_dir, "historical")
    bad = prepared(spark, "2").withColumn("C_NAME", F.raise_error(F.lit("source broke"))
                                          .cast("string"))
    with pytest.raises(Exception, match="source broke"):
        write_lake(bad, tmp_dir, "historical")
    assert read_lake(spark, tmp_dir).count() == n
    write_lake(prepared(spark, "2"), tmp_dir, "historical")
    assert {r[0] for r in read_lake(spark, tmp_dir).select("ETL_BATCH_ID").collect()} == {"2"}


def test_whole_lake_and_one_batch_have_all_columns(spark, tmp_dir):
    s = spec(tmp_dir, "t", target=False)
    ingest_frame(spark, rows(spark, x=1, gone="g"), s, cfg("incremental", "1"))
    ingest_frame(spark, rows(spark, x=1, newCol="n"), s, cfg("incremental", "2"))
    whole = read_lake(spark, s.lake_path)
    assert {"X", "GONE", "NEW_COL"} <= set(whole.columns)
    assert read_lake(spark, s.lake_path, batch_id="1").columns == whole.columns
    got = {(r["ETL_BATCH_ID"], r["GONE"], r["NEW_COL"]) for r in whole.collect()}
    assert got == {("1", "g", None), ("2", None, "n")}
    assert whole.schema["ETL_BATCH_ID"].dataType.simpleString() == "string"
    row = ingest_frame(spark, rows(spark, x="text"), s, cfg("incremental", "3"))
    assert row["status"] == "failed" and "column type changed: X" in row["reason"]
    assert len(stored_schema(spark, s.lake_path)) == len(whole.columns)


@pytest.mark.parametrize("external", [False, True])
def test_a_catalog_table_gets_new_columns_and_is_replaced_whole(spark, tmp_dir, external):
    name = f"safety_{int(external)}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    options = {"path": f"{tmp_dir}/ext"} if external else {}
    s = dataclasses.replace(spec(tmp_dir, "t"), target=Target(kind="table", name=name,
                                                              options=options))
    for b, df in (("1", rows(spark, x=1)), ("2", rows(spark, x=2, more="m")),
                  ("2", rows(spark, x=3, more="m")), ("3", rows(spark))):
        row = ingest_frame(spark, df, s, cfg("incremental", b))
        assert row["status"] == "success", row
    got = {(r["ETL_BATCH_ID"], r["X"], r["MORE"]) for r in spark.table(name).collect()}
    assert got == {("1", 1, None), ("2", 3, "m"), ("3", None, None)}
    row = ingest_frame(spark, rows(spark, x=9), s, cfg("historical", "4"))
    assert row["status"] == "success" and row["load_action"] == "replace"
    assert {(r["ETL_BATCH_ID"], r["X"]) for r in spark.table(name).collect()} == {("4", 9)}
    assert "MORE" in spark.table(name).columns
    ingest_frame(spark, rows(spark, x=9), s, cfg("incremental", "5"))
    ingest_frame(spark, rows(spark, 0), s, cfg("incremental", "5"))
    assert {r[0] for r in spark.table(name).select("ETL_BATCH_ID").collect()} == {"4"}


def test_a_lost_column_fails_the_run(spark, tmp_dir, monkeypatch):
    from tidewater.plans import ingest
    monkeypatch.setattr(ingest, "target_columns", lambda *a: ["A"])
    row = ingest_frame(spark, rows(spark, x=1), spec(tmp_dir, "t"), cfg())
    assert row["status"] == "failed" and row["ok"] is False and "columns lost" in row["reason"]


def test_default_schema_of_catalog_targets(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS safety_db")
    t = Target(kind="table", name="t1", default_schema="safety_db")
    spark.sql("DROP TABLE IF EXISTS safety_db.t1")
    assert not target_exists(spark, t)
    write_target(prepared(spark, "1"), t, resolve_load("incremental", False), "1")
    assert target_exists(spark, t) and spark.table("safety_db.t1").count() > 0


def test_wrong_zone_fails_and_overwritten_columns_are_reported(spark, tmp_dir):
    with pytest.raises(ValueError, match="timeZone"):
        check_zone(spark, "Europe/Vienna")
    row = ingest_table(spark, spec(tmp_dir, "customer"),
                       dataclasses.replace(cfg(), time_zone="Europe/Vienna"))
    assert row["status"] == "failed" and "timeZone" in row["reason"]
    s = spec(tmp_dir, "t")
    row = ingest_frame(spark, rows(spark, EtlRowHash="x", stgTKey="y", createdBy="z"), s, cfg())
    assert row["shadowed"] == "ETL_ROW_HASH,STG_T_KEY,CREATED_BY"


def test_tables_run_side_by_side_and_report_in_order(spark, tmp_dir, capsys):
    specs = [dataclasses.replace(spec(tmp_dir, "region"), name=f"t{i:02d}",
                                 lake_path=f"{tmp_dir}/l{i}",
                                 target=None) for i in range(25)]
    report = ingest_all(spark, specs, dataclasses.replace(cfg(), max_in_flight=6))
    assert [r["table_name"] for r in report.collect()] == [s.name for s in specs]
    assert {r["status"] for r in report.collect()} == {"success"}
    report.show(len(specs), truncate=False)
    assert "t24" in capsys.readouterr().out


def test_settings_reach_the_run_and_unknown_ones_raise(spark, tmp_dir):
    doc = {"mode": "incremental", "created_by": "me", "source_system": "S", "future": "keep",
           "min_year": 1950, "max_in_flight": 2, "as_of": "2000-01-01 00:00:00",
           "tables": [{"name": "t", "source": {"kind": "jdbc", "name": "dbo.t", "options": {},
                                               "partition_column": "id", "partitions": 8},
                       "hash_column": "K", "lake_path": f"{tmp_dir}/l"}]}
    specs, config = specs_from_dict(doc)
    assert (config.future, config.min_year, config.max_in_flight) == ("keep", 1950, 2)
    assert (specs[0].source.partition_column, specs[0].source.partitions) == ("id", 8)
    df = spark.sql("SELECT TIMESTAMP '2000-06-01 00:00:00' AS t, TIMESTAMP '1940-01-01 00:00:00' AS u")
    s = dataclasses.replace(specs[0], source=Source(kind="path", name="unused"))
    ingest_frame(spark, df, s, dataclasses.replace(config, batch_id="1"))
    got = read_lake(spark, f"{tmp_dir}/l").first()
    assert got["T"].year == 2000 and got["U"] is None
    for bad in ({"futur": "keep"}, {"tables": [{**doc["tables"][0], "lake": "x"}]}):
        with pytest.raises(ValueError, match="unknown key"):
            specs_from_dict({**doc, **bad})
    with pytest.raises(ValueError, match="future"):
        RunConfig(mode="incremental", created_by="a", source_system="b", future="no")
    with pytest.raises(ValueError, match="one of"):
        Source(kind="jdbc", name="t", partition_column="a", partitions=2, predicates=("a = 1",))


def test_real_bounds_and_predicates_reach_the_reader(spark, monkeypatch):
    from tidewater.sources import jdbc
    seen = []

    def read(spark_, url, query=None, table=None, options=None, partitioning=None,
             predicates=None):
        seen.append((query, partitioning, predicates))
        return spark.createDataFrame([(3, 77)], "lo int, hi int")

    monkeypatch.setattr(jdbc, "read_jdbc", read)
    Source(kind="jdbc", name="dbo.t", options={"url": "u"}, partition_column="id",
           partitions=4).load(spark)
    assert seen[0][0] == "SELECT MIN(id) AS lo, MAX(id) AS hi FROM dbo.t"
    assert seen[1][1].options() == {"partitionColumn": "id", "lowerBound": "3", "upperBound": "77",
                                    "numPartitions": "4"}
    Source(kind="jdbc", name="dbo.t", options={"url": "u"}, predicates=("a < 5", "a >= 5")).load(spark)
    assert seen[2][2] == ("a < 5", "a >= 5")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        @staticmethod
        def get(key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Session:
        conf = Conf
        sparkContext = None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session())


def test_lake_files_are_zstd(spark, tmp_dir):
    write_lake(prepared(spark, "1"), tmp_dir, "incremental")
    names = [f for _, _, fs in os.walk(tmp_dir) for f in fs if f.endswith(".parquet")]
    assert names and all(".zstd." in f for f in names)
