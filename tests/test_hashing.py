import hashlib

from hypothesis import given, settings, strategies as st

from tidewater.constants import AUDIT_COLUMNS, ROW_HASH
from tidewater.operators import add_row_hash, add_audit_columns


def py_hash(values, bits=512):
    text = "||".join("" if v is None else str(v) for v in values)
    return getattr(hashlib, f"sha{bits}")(text.encode()).hexdigest()


def test_sha512_matches_hashlib(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "y", "z")], "B int, A string, C string")
    rows = add_row_hash(df, "K").orderBy("B").collect()
    # sorted names: A, B, C
    assert rows[0]["K"] == py_hash(["x", "1", None])
    assert rows[1]["K"] == py_hash(["y", "2", "z"])
    assert all(len(r["K"]) == 128 for r in rows)
    assert all(r["K"] == r[ROW_HASH] for r in rows)


def test_layout_hash_first_row_hash_last(spark):
    df = spark.createDataFrame([(1, "x")], "ID int, NAME string")
    assert add_row_hash(df, "K").columns == ["K", "ID", "NAME", ROW_HASH]


def test_existing_row_hash_replaced_in_place(spark):
    df = spark.createDataFrame([(1, "old", "x")], f"ID int, {ROW_HASH} string, NAME string")
    out = add_row_hash(df, "K")
    assert out.columns == ["K", "ID", ROW_HASH, "NAME"]
    r = out.first()
    assert r[ROW_HASH] == r["K"] == py_hash(["1", "x"])


def test_no_hash_column_is_noop(spark):
    df = spark.createDataFrame([(1,)], "ID int")
    assert add_row_hash(df, None) is df


def test_null_and_empty_collide_by_default(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", "")], "id int, a string, b string")
    h = add_row_hash(df.select("a", "b"), "K").collect()
    assert h[0]["K"] == h[1]["K"]
    safe = add_row_hash(df.select("a", "b"), "K", null_safe=True).collect()
    assert safe[0]["K"] != safe[1]["K"]


def test_delimiter_shift_collides_by_default(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "a string, b string")
    h = add_row_hash(df, "K").collect()
    assert h[0]["K"] == h[1]["K"]
    safe = add_row_hash(df, "K", null_safe=True).collect()
    assert safe[0]["K"] != safe[1]["K"]


def test_column_order_does_not_matter(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    a = add_row_hash(df, "K").select("o_orderkey", "K")
    b = add_row_hash(df.select(*reversed(df.columns)), "K").select("o_orderkey", "K")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_audit_columns_not_hashed(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    a = add_row_hash(df, "K").select("o_orderkey", "K")
    audited = add_audit_columns(df, "B1", "me", "src", run_ts="2020-01-01 00:00:00")
    b = add_row_hash(audited, "K").select("o_orderkey", "K")
    assert a.exceptAll(b).isEmpty()


def test_only_audit_columns_hash_empty_string(spark):
    df = add_audit_columns(spark.range(2).drop("id"), "B1", "me", "src")
    assert set(df.columns) < AUDIT_COLUMNS
    rows = add_row_hash(df, "K").collect()
    assert {r["K"] for r in rows} == {hashlib.sha512(b"").hexdigest()}


def test_bits_validated():
    import pytest
    from tidewater.functions.hashing import row_hash_expr
    with pytest.raises(ValueError):
        row_hash_expr(["a"], bits=128)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab|c", max_size=5)), min_size=3, max_size=3),
       st.integers(min_value=0, max_value=2), st.text(alphabet="xyz", min_size=1, max_size=3))
def test_changing_one_value_changes_hash(spark, vals, idx, new):
    changed = list(vals)
    changed[idx] = (vals[idx] or "") + new
    df = spark.createDataFrame([(0, *vals), (1, *changed)], "i int, a string, b string, c string")
    rows = add_row_hash(df, "K", exclude=("i",)).orderBy("i").collect()
    assert rows[0]["K"] == py_hash(vals) and rows[1]["K"] == py_hash(changed)
    assert rows[0]["K"] != rows[1]["K"]


def test_hash_single_pass_in_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = add_row_hash(df, "K")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sha2(") == 1


def test_other_sha2_sizes_match_hashlib(spark):
    df = spark.createDataFrame([(1, "x")], "A int, B string")
    for bits in (224, 256, 384):
        r = add_row_hash(df, "K", bits=bits).first()
        assert r["K"] == py_hash(["1", "x"], bits)


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x", "y")], "`a.b` int, `c d` string, `e``f` string")
    r = add_row_hash(df, "K").first()
    # sorted names: "a.b", "c d", "e`f"
    assert r["K"] == py_hash(["1", "x", "y"])
    assert add_row_hash(df, "K").columns == ["K", "a.b", "c d", "e`f", ROW_HASH]
