import datetime as dt

from tidewater.constants import APPENDED_AUDIT
from tidewater.operators import add_audit_columns, shadowed_columns
from tidewater.operators.audit import new_batch_id


def test_columns_appended_in_order(spark):
    df = spark.createDataFrame([(1, "x")], "ID int, NAME string")
    out = add_audit_columns(df, "20240101000000", "me", "SRC", run_ts="2024-01-01 00:00:00")
    assert out.columns == ["ID", "NAME", *APPENDED_AUDIT]
    r = out.first()
    assert r["CREATED_BY"] == "me" and r["EDW_EXTERNAL_SOURCE_SYSTEM"] == "SRC"
    assert r["TO_PROCESS"] is True and r["ETL_BATCH_ID"] == "20240101000000"
    assert r["ETL_CREATED_DATE"] == r["ETL_LAST_UPDATE_DATE"] == dt.datetime(2024, 1, 1)
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types["ETL_CREATED_DATE"] == "timestamp" and types["TO_PROCESS"] == "boolean"


def test_shadowed_source_column_overwritten_in_place(spark):
    df = spark.createDataFrame([("someone", 1)], "CREATED_BY string, ID int")
    out = add_audit_columns(df, "B", "me", "SRC")
    assert out.columns[:2] == ["CREATED_BY", "ID"]
    assert out.first()["CREATED_BY"] == "me"
    assert shadowed_columns(df.columns) == ["CREATED_BY"]


def test_default_batch_id_format():
    b = new_batch_id(dt.datetime(2024, 3, 5, 6, 7, 8))
    assert b == "20240305060708"
    assert len(new_batch_id()) == 14


def test_one_timestamp_per_query(spark):
    out = add_audit_columns(spark.range(1000).repartition(8), None, "me", "SRC").collect()
    assert len({(r["ETL_CREATED_DATE"], r["ETL_LAST_UPDATE_DATE"]) for r in out}) == 1
    assert len({r["ETL_BATCH_ID"] for r in out}) == 1


def test_aware_run_ts_is_an_instant(spark):
    ts = dt.datetime(2024, 1, 1, 12, 0, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    out = add_audit_columns(spark.range(1), "B", "me", "SRC", run_ts=ts).first()
    # session zone is UTC in the tests: 12:00+02:00 is 10:00 UTC
    assert out["ETL_CREATED_DATE"] == dt.datetime(2024, 1, 1, 10, 0)
