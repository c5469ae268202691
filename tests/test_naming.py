import pytest
from hypothesis import given, strategies as st

from tidewater.functions.naming import normalized_names, snake_upper

EXPECTED = {
    "SalesOrderID": "SALES_ORDER_ID",
    "HTTPServer": "HTTP_SERVER",
    "lead_id": "LEAD_ID",
    "address1": "ADDRESS_1",
    "Address2Line": "ADDRESS_2_LINE",
    "iPhone": "I_PHONE",
    "ABc": "A_BC",
    "aB": "A_B",
    "café": "CAF",
    "日付": "",
    "o_orderkey": "O_ORDERKEY",
    "__weird--name__": "WEIRD_NAME",
}


@pytest.mark.parametrize("name,want", sorted(EXPECTED.items()))
def test_snake_upper(name, want):
    assert snake_upper(name) == want


def test_duplicates_numbered_in_order():
    assert normalized_names(["CustKey", "custKey", "cust_key"]) == [
        "CUST_KEY", "CUST_KEY_1", "CUST_KEY_2"]


def test_duplicate_suffix_never_collides():
    # X, x, x1 -> X, X, X_1: the repeat skips X_1, which x1 owns
    assert normalized_names(["X", "x", "x1"]) == ["X", "X_2", "X_1"]


def test_empty_name_falls_back_to_position():
    assert normalized_names(["日付", "a"]) == ["COL_1", "A"]


@given(st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=12))
def test_output_unique_and_clean(names):
    out = normalized_names(names)
    assert len(out) == len(names)
    assert len(set(out)) == len(out)
    for n in out:
        assert n and all(ch in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_" for ch in n)
        assert not n.startswith("_") and "__" not in n


def test_normalize_columns_frame(spark):
    from tidewater.operators import normalize_columns
    df = spark.createDataFrame([(1, "a", 2.0)], "SalesOrderID int, `café` string, `日付` double")
    assert normalize_columns(df).columns == ["SALES_ORDER_ID", "CAF", "COL_3"]


@given(st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=12))
def test_normalizing_twice_changes_nothing(names):
    once = normalized_names(names)
    assert normalized_names(once) == once
