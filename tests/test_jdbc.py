"""JDBC readers and writers, checked through a recording stand-in for the
DataFrameReader/Writer: no database is started for tests."""

import pytest

from tidewater.plans import Source, Target
from tidewater.sinks import resolve_load, write_target
from tidewater.sources import JdbcPartitioning, count_query, full_table_query, read_jdbc, subquery


class Rec:
    """Records builder calls; every method returns itself."""

    def __init__(self):
        self.opts, self.calls = {}, []

    def format(self, f):
        self.calls.append(("format", f)); return self

    def option(self, k, v):
        self.opts[k] = v; return self

    def options(self, **kw):
        self.opts.update(kw); return self

    def mode(self, m):
        self.calls.append(("mode", m)); return self

    def load(self):
        self.calls.append(("load",)); return "df"

    def save(self):
        self.calls.append(("save",))

    def jdbc(self, url, table, predicates=None, properties=None):
        self.calls.append(("jdbc", url, table, tuple(predicates), dict(properties))); return "df"


class FakeSpark:
    def __init__(self):
        self.read = Rec()


def test_query_text():
    assert subquery("SELECT 1") == "(SELECT 1) src"
    assert full_table_query("dbo.[Orders]", "WITH (NOLOCK)") == "SELECT * FROM dbo.[Orders] WITH (NOLOCK)"
    assert count_query("t") == "SELECT COUNT(*) AS total_count FROM t"


def test_read_jdbc_query_with_partitioning():
    s = FakeSpark()
    read_jdbc(s, "jdbc:x://h", query="SELECT * FROM t", options={"user": "u"},
              partitioning=JdbcPartitioning("id", "0", "1000", 16))
    o = s.read.opts
    assert o["dbtable"] == "(SELECT * FROM t) src" and o["url"] == "jdbc:x://h"
    assert o["fetchsize"] == "50000" and o["user"] == "u"
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == (
        "id", "0", "1000", "16")
    assert ("format", "jdbc") in s.read.calls


def test_read_jdbc_predicates():
    s = FakeSpark()
    read_jdbc(s, "jdbc:x://h", table="t", predicates=["id < 10", "id >= 10"])
    kind, url, table, preds, props = s.read.calls[0]
    assert (kind, table, preds) == ("jdbc", "t", ("id < 10", "id >= 10"))
    assert props["fetchsize"] == "50000"


def test_read_jdbc_needs_one_of_query_or_table():
    with pytest.raises(ValueError):
        read_jdbc(FakeSpark(), "u")


def test_source_jdbc_builds_full_table_query():
    s = FakeSpark()
    Source(kind="jdbc", name="dbo.[Orders]", hint="WITH (NOLOCK)",
           options={"url": "jdbc:x://h", "user": "u"}).load(s)
    assert s.read.opts["dbtable"] == "(SELECT * FROM dbo.[Orders] WITH (NOLOCK)) src"
    assert "url" in s.read.opts and s.read.opts["user"] == "u"


class FakeDF:
    def __init__(self):
        self.write = Rec()


@pytest.mark.parametrize("mode,exists,save_mode,truncate", [
    ("historical", True, "overwrite", "true"),
    ("historical", False, "overwrite", None),
    ("incremental", True, "append", None),
    ("incremental", False, "overwrite", None),
])
def test_jdbc_target_modes(mode, exists, save_mode, truncate):
    df = FakeDF()
    t = Target(kind="jdbc", name="STG_T", default_database="DB", default_schema="S",
               options={"url": "jdbc:x://h", "batchsize": "10000"})
    write_target(df, t, resolve_load(mode, exists))
    o = df.write.opts
    assert o["dbtable"] == "DB.S.STG_T" and o["batchsize"] == "10000"
    assert ("mode", save_mode) in df.write.calls and ("save",) in df.write.calls
    assert o.get("truncate") == truncate


def test_connector_target_truncate_options():
    df = FakeDF()
    t = Target(kind="connector", name="db.s.t", format="some.connector",
               truncate_options={"truncate_table": "on"})
    write_target(df, t, resolve_load("historical", True))
    assert df.write.opts["truncate_table"] == "on" and df.write.opts["dbtable"] == "db.s.t"
    assert ("format", "some.connector") in df.write.calls


class Row1:
    def __init__(self, *v):
        self.v = v

    def __getitem__(self, i):
        return self.v[i]


class BoundsRec(Rec):
    def __init__(self, row):
        super().__init__()
        self.row = row

    def load(self):
        rec = self

        class D:
            def first(self_inner):
                return rec.row
        return D()


def test_partitioning_from_bounds():
    from tidewater.sources import partitioning_for
    s = FakeSpark()
    s.read = BoundsRec(Row1(5, 905))
    p = partitioning_for(s, "jdbc:x://h", "t", "id", 8)
    assert s.read.opts["dbtable"] == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM t) src"
    assert p.options() == {"partitionColumn": "id", "lowerBound": "5", "upperBound": "905",
                           "numPartitions": "8"}
    s.read = BoundsRec(Row1(None, None))
    assert partitioning_for(s, "jdbc:x://h", "t", "id", 8) is None


def test_read_query_connector():
    from tidewater.sources import read_query
    s = FakeSpark()
    read_query(s, "some.connector", {"sfUser": "u"}, "SELECT 1")
    assert s.read.opts == {"sfUser": "u", "query": "SELECT 1"}
    assert ("format", "some.connector") in s.read.calls


class ExistsSpark:
    def __init__(self, cnt=None, fail=False):
        self.read = BoundsRec(Row1(cnt))
        self.fail = fail
        if fail:
            def boom():
                raise RuntimeError("connection refused")
            self.read.load = boom


@pytest.mark.parametrize("kind", ["jdbc", "connector"])
def test_target_exists_metadata_query(kind):
    from tidewater.sources import target_exists
    t = Target(kind=kind, name="S.T", default_database="DB", format="some.connector",
               options={"url": "jdbc:x://h"})
    s = ExistsSpark(cnt=1)
    assert target_exists(s, t) is True
    q = s.read.opts.get("dbtable") or s.read.opts.get("query")
    assert "DB.INFORMATION_SCHEMA.TABLES" in q and "TABLE_SCHEMA = 'S'" in q
    assert "TABLE_NAME = 'T'" in q
    assert target_exists(ExistsSpark(cnt=0), t) is False


def test_target_exists_error_raises():
    from tidewater.sources import target_exists
    t = Target(kind="connector", name="T", format="c")
    with pytest.raises(RuntimeError):
        target_exists(ExistsSpark(fail=True), t)


def test_session_conf_and_scratch(spark):
    from tidewater.plans.session import scratch_dir, session_conf
    c = session_conf(shuffle_partitions=64)
    assert c["spark.sql.adaptive.enabled"] == "true"
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert c["spark.sql.shuffle.partitions"] == "64"
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and spark.sparkContext.getCheckpointDir().rstrip("/") in a


class SessRec(Rec):
    def load(self):
        self.calls.append(("load",))

        class D:
            def collect(self_inner):
                return []
        return D()


class FakeDFWithSession(FakeDF):
    def __init__(self):
        super().__init__()

        class S:
            read = SessRec()
        self.sparkSession = S()


def test_jdbc_replace_batch_deletes_before_append():
    df = FakeDFWithSession()
    t = Target(kind="jdbc", name="STG_T", default_database="DB", default_schema="S",
               options={"url": "jdbc:x://h", "numPartitions": "8"}, replace_batch=True)
    write_target(df, t, resolve_load("incremental", True), batch_id="20240101000000")
    r = df.sparkSession.read
    assert r.opts["sessionInitStatement"] == (
        "DELETE FROM DB.S.STG_T WHERE ETL_BATCH_ID = '20240101000000'")
    assert r.opts["dbtable"] == "(SELECT 1 AS done) src" and "numPartitions" not in r.opts
    assert ("mode", "append") in df.write.calls


def test_jdbc_no_delete_without_opt_in_or_on_replace():
    df = FakeDFWithSession()
    t = Target(kind="jdbc", name="T", options={"url": "u"})
    write_target(df, t, resolve_load("incremental", True), batch_id="1")
    assert "sessionInitStatement" not in df.sparkSession.read.opts
    t2 = Target(kind="jdbc", name="T", options={"url": "u"}, replace_batch=True)
    write_target(df, t2, resolve_load("historical", True), batch_id="1")
    assert "sessionInitStatement" not in df.sparkSession.read.opts


def test_source_count_runs_in_the_database():
    s = FakeSpark()
    s.read = BoundsRec(Row1(42))
    src = Source(kind="jdbc", name="dbo.[Orders]", hint="WITH (NOLOCK)", options={"url": "u"})
    assert src.count_rows(s) == 42
    assert s.read.opts["dbtable"] == (
        "(SELECT COUNT(*) AS total_count FROM dbo.[Orders] WITH (NOLOCK)) src")
