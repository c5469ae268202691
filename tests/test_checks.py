from pyspark.sql import functions as F

from tidewater.constants import AUDIT_COLUMNS
from tidewater.operators import gate_reasons, load_gate, reconcile
from tidewater.operators.checks import is_load_ready
from tidewater.plans.prepare import prepare

SF = "/root/testdata/sf0.001"


def test_gate_reasons_schema():
    cols = sorted(AUDIT_COLUMNS) + ["K", "A"]
    assert gate_reasons(cols, "K") == []
    r = gate_reasons([c for c in cols if c != "TO_PROCESS"], "K")
    assert r == ["missing audit columns: TO_PROCESS"]
    assert gate_reasons(cols, "OTHER") == ["missing hash column: OTHER"]
    # exact-case comparison
    assert gate_reasons([c.lower() for c in cols], None)[0].startswith("missing audit columns")


def test_gate_frame(spark):
    df = prepare(spark.read.parquet(f"{SF}/orders.parquet"), "K", "B", "me", "S")
    r = load_gate(df, "K", "orders").first()
    assert r["ready"] is True and r["reasons"] == "" and r["table_name"] == "orders"
    empty = load_gate(df.where(F.lit(False)), "K", "e").first()
    assert empty["ready"] is False and empty["reasons"] == "empty"
    raw = load_gate(spark.read.parquet(f"{SF}/orders.parquet").where(F.lit(False)), "K").first()
    assert raw["reasons"].startswith("empty; missing audit columns")


def test_is_load_ready(spark):
    df = prepare(spark.read.parquet(f"{SF}/orders.parquet"), "K", "B", "me", "S")
    assert is_load_ready(df, "K") == []
    assert is_load_ready(df.where(F.lit(False)), "K") == ["empty"]
    assert is_load_ready(df.drop("TO_PROCESS"), "K") == ["missing audit columns: TO_PROCESS"]


def test_reconcile():
    assert reconcile(5, 5, 5) is True
    assert reconcile(5, 5, None) is True
    assert reconcile(5, 4, 5) is False
    assert reconcile(None, None, None) is None
