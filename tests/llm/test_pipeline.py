"""The pipeline's stages against brute force, chained as run() chains them."""

import json
import os

import pytest

import corpus_pipeline
from tidewater.llm.queries import ORACLES, QUERIES

from .frames import documents, prose, rows
from .test_line_dedup import plain as plain_lines
from .test_quality_rules import plain as plain_signals
from .test_simhash import plain_components, plain_fingerprint

NAMES = ["quality rules", "line dedup", "simhash near-dedup", "source mixing", "best-fit packing"]


def corpus():
    out = [r for r in rows() if r[0] not in (None, 1, 107)]
    out += [(1000 + i, prose(i // 2, 60 + i), "en", f"s{i % 3}", 1) for i in range(40)]
    return [r for i, r in enumerate(out) if r not in out[:i]]


def test_stages_in_order_match_brute_force(spark, tmp_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = documents(spark, corpus())
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tmp_dir)
        path = f"{tmp_dir}/{name}"
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != NAMES[-1]:
            assert docs.columns == before.columns
        kept[name] = [tuple(r) for r in docs.collect()]
    first = [r for r in corpus() if not (
        plain_signals(r[1])[0] < 10 or 100 * plain_signals(r[1])[4] > 20 * plain_signals(r[1])[0])]
    assert {r[0] for r in kept[NAMES[0]]} <= {r[0] for r in first}
    assert len(kept[NAMES[0]]) > 30
    lines = plain_lines(kept[NAMES[0]])
    texts = {r[0]: r[1] for r in kept[NAMES[0]]}
    assert {r[0]: r[1] for r in kept[NAMES[1]]} == {k: lines[k, t] for k, t in texts.items()}
    assert all(r[4] == len(r[1]) for r in kept[NAMES[1]] if r[1] != texts[r[0]])
    ids = [r[0] for r in kept[NAMES[1]]]
    roots = plain_components(ids, [plain_fingerprint(r[1]) for r in kept[NAMES[1]]])
    assert sorted(r[0] for r in kept[NAMES[2]]) == sorted(set(roots))
    unique = set(kept[NAMES[2]])
    assert set(kept[NAMES[3]]) <= unique
    pieces = kept[NAMES[4]]
    assert len({(r[0], r[5]) for r in pieces if r[1] == 0}) <= len(kept[NAMES[3]])
    assert sum(r[1] == 0 for r in pieces) == len(kept[NAMES[3]])


def test_every_dealt_operator_is_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(ORACLES) <= set(QUERIES)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, duck, name):
    from scripts.oracle_check import digest
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.sql(ORACLES[name]).df()
    assert digest(got) == digest(want), json.dumps([got.head().to_dict(), want.head().to_dict()],
                                                   default=str)
