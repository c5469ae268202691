import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators import sanitize_timestamps, add_audit_columns

AS_OF = "2020-06-01 12:00:00"


def edges(spark):
    vals = [None, "1899-12-31 23:59:59", "1900-01-01 00:00:00", AS_OF,
            "2020-06-01 12:00:01", "2023-06-01 12:00:00"]
    rows = [(i, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id int, s string")
    return df.select(
        "id",
        F.col("s").cast("timestamp").alias("t"),
        F.col("s").cast("timestamp_ntz").alias("n"),
        F.col("s").cast("timestamp").cast("date").alias("d"),
        F.col("s").cast("timestamp").alias("ETL_T"),
    )


def test_ltz_rules_and_ntz_untouched(spark):
    out = sanitize_timestamps(edges(spark), as_of=AS_OF).orderBy("id").collect()
    kept = [r["t"] is not None for r in out]
    assert kept == [False, False, True, True, False, False]
    # NTZ and DATE untouched by default
    assert [r["n"] is not None for r in out] == [False, True, True, True, True, True]
    assert [r["d"] is not None for r in out] == [False, True, True, True, True, True]


def test_types_kept(spark):
    df = edges(spark)
    out = sanitize_timestamps(df, as_of=AS_OF, include_ntz=True)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in df.schema.fields]


def test_include_ntz(spark):
    out = sanitize_timestamps(edges(spark), as_of=AS_OF, include_ntz=True).orderBy("id").collect()
    assert [r["n"] is not None for r in out] == [False, False, True, True, False, False]


def test_future_keep(spark):
    out = sanitize_timestamps(edges(spark), as_of=AS_OF, future="keep").orderBy("id").collect()
    # only NULL, < 1900 and > next year are dropped
    assert [r["t"] is not None for r in out] == [False, False, True, True, True, False]


def test_etl_columns_filled_with_as_of(spark):
    out = sanitize_timestamps(edges(spark), as_of=AS_OF).orderBy("id").collect()
    want = dt.datetime(2020, 6, 1, 12, 0, 0)
    assert out[0]["ETL_T"] == want and out[1]["ETL_T"] == want and out[4]["ETL_T"] == want
    assert out[2]["ETL_T"] == dt.datetime(1900, 1, 1)


def test_min_year_parameter(spark):
    out = sanitize_timestamps(edges(spark), as_of=AS_OF, min_year=1901).orderBy("id").collect()
    assert out[2]["t"] is None


def test_current_time_default(spark):
    df = spark.createDataFrame([("2999-01-01 00:00:00",), ("2000-01-01 00:00:00",)], "s string")
    out = sanitize_timestamps(df.select(F.col("s").cast("timestamp").alias("t"))).collect()
    assert sorted(r["t"] is None for r in out) == [False, True]


def test_audit_dates_survive_cleanup(spark):
    df = add_audit_columns(spark.range(3), "B", "me", "src")
    out = sanitize_timestamps(df).collect()
    assert all(r["ETL_CREATED_DATE"] is not None for r in out)
    assert len({r["ETL_CREATED_DATE"] for r in out}) == 1


def test_future_validated_without_timestamp_columns(spark):
    import pytest
    with pytest.raises(ValueError):
        sanitize_timestamps(spark.range(1), future="drop")


def test_ntz_against_current_local_time(spark):
    df = spark.createDataFrame([("2999-01-01 00:00:00",), ("2000-01-01 00:00:00",)], "s string")
    ntz = df.select(F.col("s").cast("timestamp_ntz").alias("n"))
    out = sanitize_timestamps(ntz, include_ntz=True).collect()
    assert sorted(r["n"] is None for r in out) == [False, True]
    assert dict(sanitize_timestamps(ntz, include_ntz=True).dtypes)["n"] == "timestamp_ntz"
