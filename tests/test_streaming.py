import pytest

from tidewater.plans import RunConfig, Source, TableSpec, Target
from tidewater.sources import read_lake
from tidewater.streaming import epoch_batch_id, ingest_stream

SF = "/root/testdata/sf0.001"


def test_epoch_batch_id_sorts():
    assert epoch_batch_id("S", 3) == "S0000000003"
    assert epoch_batch_id("S", 10) > epoch_batch_id("S", 9)


def test_stream_lands_and_loads_each_epoch(spark, tmp_dir):
    schema = spark.read.parquet(f"{SF}/customer.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "customer.parquet").parquet(SF)
    spec = TableSpec(name="customer", source=Source(kind="path", name="unused"), hash_column="K",
                     lake_path=f"{tmp_dir}/lake", target=Target(kind="path", name=f"{tmp_dir}/wh"))
    cfg = RunConfig(mode="historical", created_by="me", source_system="SRC")
    q = ingest_stream(stream, spec, cfg, f"{tmp_dir}/ckpt", "S", report_path=f"{tmp_dir}/rep")
    q.awaitTermination(120)
    assert q.exception() is None
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    rep = spark.read.parquet(f"{tmp_dir}/rep").collect()
    assert [(r.status, r.mode, r.batch_id, r.rows_in, r.ok) for r in rep] == [
        ("success", "incremental", "S0000000000", n, True)]
    assert read_lake(spark, f"{tmp_dir}/wh").count() == n
    # restarting from the checkpoint finds nothing new: no duplicate batch
    q2 = ingest_stream(stream, spec, cfg, f"{tmp_dir}/ckpt", "S", report_path=f"{tmp_dir}/rep")
    q2.awaitTermination(120)
    assert read_lake(spark, f"{tmp_dir}/lake").count() == n


def test_batch_frame_rejected(spark, tmp_dir):
    spec = TableSpec(name="c", source=Source(kind="path", name="x"), hash_column="K",
                     lake_path=tmp_dir)
    cfg = RunConfig(mode="incremental", created_by="me", source_system="SRC")
    with pytest.raises(ValueError):
        ingest_stream(spark.range(1), spec, cfg, tmp_dir + "/c", "S")


def test_failed_epoch_replays_into_the_same_batch(spark, tmp_dir):
    schema = spark.read.parquet(f"{SF}/customer.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "customer.parquet").parquet(SF)
    cfg = RunConfig(mode="incremental", created_by="me", source_system="SRC")
    broken = TableSpec(name="customer", source=Source(kind="path", name="unused"), hash_column="K",
                       lake_path=f"{tmp_dir}/lake",
                       target=Target(kind="path", name=f"{tmp_dir}/wh", format="no.such.fmt"))
    q = ingest_stream(stream, broken, cfg, f"{tmp_dir}/ckpt", "S", report_path=f"{tmp_dir}/rep")
    with pytest.raises(Exception):
        q.awaitTermination(120)
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    # the lake write of epoch 0 happened before the target failed
    assert read_lake(spark, f"{tmp_dir}/lake").count() == n
    fixed = TableSpec(name="customer", source=Source(kind="path", name="unused"), hash_column="K",
                      lake_path=f"{tmp_dir}/lake", target=Target(kind="path", name=f"{tmp_dir}/wh"))
    q2 = ingest_stream(stream, fixed, cfg, f"{tmp_dir}/ckpt", "S", report_path=f"{tmp_dir}/rep")
    q2.awaitTermination(120)
    assert q2.exception() is None
    lake = read_lake(spark, f"{tmp_dir}/lake")
    assert lake.count() == n and [r[0] for r in lake.select("ETL_BATCH_ID").distinct().collect()] == [
        "S0000000000"]
    assert read_lake(spark, f"{tmp_dir}/wh").count() == n
    statuses = sorted(r.status for r in spark.read.parquet(f"{tmp_dir}/rep").collect())
    assert statuses == ["failed", "success"]
