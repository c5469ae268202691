import pytest

from tidewater.constants import BATCH_ID
from tidewater.plans import Target
from tidewater.plans.prepare import prepare
from tidewater.sinks import qualify, resolve_load, validate_mode, write_lake, write_target
from tidewater.sinks.table import count_target
from tidewater.sources import read_lake, target_exists
from tidewater.sources.catalog import metadata_query, split_table_name

SF = "/root/testdata/sf0.001"


def prepared(spark, batch, table="customer"):
    df = spark.read.parquet(f"{SF}/{table}.parquet")
    return prepare(df, "K", batch, "me", "SRC", run_ts="2024-01-01 00:00:00",
                   as_of="2024-01-01 00:00:00")


@pytest.mark.parametrize("mode,exists,replace,keep,creates,save", [
    ("historical", True, True, True, False, "overwrite"),
    ("historical", False, True, False, True, "overwrite"),
    ("incremental", True, False, True, False, "append"),
    ("incremental", False, True, False, True, "overwrite"),
    ("HISTORICAL", True, True, True, False, "overwrite"),
])
def test_load_matrix(mode, exists, replace, keep, creates, save):
    a = resolve_load(mode, exists)
    assert (a.replace, a.keep_schema, a.creates, a.save_mode) == (replace, keep, creates, save)


def test_mode_validation():
    assert validate_mode(" Incremental ") == "incremental"
    with pytest.raises(ValueError):
        validate_mode("full")


def test_qualify_and_split():
    assert qualify("db.s.t", "D", "S") == "db.s.t"
    assert qualify("s.t", "D", "S") == "D.s.t"
    assert qualify("t", "D", "S") == "D.S.t"
    assert qualify("t", None, None) == "t"
    assert split_table_name("a.b.c", None, None) == ("a", "b", "c")
    with pytest.raises(ValueError):
        split_table_name("a.b.c.d", None, None)
    q = metadata_query("t'x", "D", "S")
    assert "D.INFORMATION_SCHEMA.TABLES" in q and "TABLE_SCHEMA = 'S'" in q
    assert "TABLE_NAME = 't''x'" in q


def test_lake_append_rerun_is_idempotent(spark, tmp_dir):
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    for b in ("20240101000000", "20240102000000", "20240102000000"):
        assert write_lake(prepared(spark, b), tmp_dir, "incremental") == n
    back = read_lake(spark, tmp_dir)
    assert dict(back.groupBy(BATCH_ID).count().collect()) == {
        "20240101000000": n, "20240102000000": n}
    assert dict(back.dtypes)[BATCH_ID] == "string"
    assert dict(read_lake(spark, tmp_dir, batch_id="20240101000000").dtypes)[BATCH_ID] == "string"
    assert read_lake(spark, tmp_dir, batch_id="20240101000000").count() == n


def test_lake_overwrite_replaces(spark, tmp_dir):
    write_lake(prepared(spark, "1"), tmp_dir, "historical")
    write_lake(prepared(spark, "2"), tmp_dir, "historical")
    assert [r[0] for r in read_lake(spark, tmp_dir).select(BATCH_ID).distinct().collect()] == ["2"]


def test_lake_batch_filter_prunes_partitions(spark, tmp_dir):
    write_lake(prepared(spark, "1"), tmp_dir, "incremental")
    write_lake(prepared(spark, "2"), tmp_dir, "incremental")
    df = read_lake(spark, tmp_dir, batch_id="2")
    assert [f for f in df.inputFiles() if "ETL_BATCH_ID=1" in f] == []
    assert df.inputFiles() and all("ETL_BATCH_ID=2" in f for f in df.inputFiles())
    whole = read_lake(spark, tmp_dir).where("ETL_BATCH_ID = '2'")
    assert whole.count() == df.count()


def test_path_target_modes(spark, tmp_dir):
    t = Target(kind="path", name=tmp_dir + "/t")
    assert target_exists(spark, t) is False
    write_target(prepared(spark, "1"), t, resolve_load("incremental", False))
    assert target_exists(spark, t) is True
    write_target(prepared(spark, "2"), t, resolve_load("incremental", True))
    write_target(prepared(spark, "2"), t, resolve_load("incremental", True))
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert count_target(spark, t) == 2 * n
    assert count_target(spark, t, "2") == n
    write_target(prepared(spark, "3"), t, resolve_load("historical", True))
    assert count_target(spark, t) == n and count_target(spark, t, "3") == n


def test_catalog_table_target_modes(spark):
    name = "tw_test_catalog_target"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    t = Target(kind="table", name=name)
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert not target_exists(spark, t)
    write_target(prepared(spark, "1"), t, resolve_load("incremental", False))
    assert target_exists(spark, t)
    write_target(prepared(spark, "2"), t, resolve_load("incremental", True), batch_id="2")
    write_target(prepared(spark, "2"), t, resolve_load("incremental", True), batch_id="2")  # re-run
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    assert count_target(spark, t) == 2 * n
    # historical on an existing table: rows replaced, table kept
    write_target(prepared(spark, "3"), t, resolve_load("historical", True))
    assert count_target(spark, t) == n and count_target(spark, t, "3") == n
    spark.sql(f"DROP TABLE {name}")


def test_probe_error_raises(spark, tmp_dir):
    bad = Target(kind="path", name=tmp_dir + "/x", format="no.such.format")
    with pytest.raises(Exception):
        target_exists(spark, bad)


def test_observed_count_matches(spark, tmp_dir):
    df = prepared(spark, "1", "lineitem")
    assert write_lake(df, tmp_dir, "historical") == df.count()


def test_catalog_replace_ignores_dynamic_session_mode(spark):
    name = "tw_test_catalog_dynamic"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    t = Target(kind="table", name=name)
    write_target(prepared(spark, "1"), t, resolve_load("incremental", False))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_target(prepared(spark, "2"), t, resolve_load("historical", True))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    got = [r[0] for r in spark.table(name).select(BATCH_ID).distinct().collect()]
    assert got == ["2"]
    spark.sql(f"DROP TABLE {name}")


def test_path_exists_marker_and_fallback(spark, tmp_dir):
    from tidewater.sources.catalog import path_exists
    assert not path_exists(spark, tmp_dir + "/none")
    write_lake(prepared(spark, "1"), tmp_dir + "/t", "incremental")
    assert path_exists(spark, tmp_dir + "/t")
    # data written without a marker (another tool) is still found
    spark.read.parquet(f"{SF}/region.parquet").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(tmp_dir + "/u")
    import os
    assert not os.path.exists(tmp_dir + "/u/_SUCCESS")
    assert path_exists(spark, tmp_dir + "/u")
