"""Source mixing: targets against plain arithmetic, copies against their definition."""

from collections import defaultdict

import pytest

from tidewater.llm import mixing

from .frames import SCHEMA, documents, prose, rows


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(most * sizes[s] for s in full)
        share = sum(w[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else w[s] * left / share for s in names}
        above = {s for s in names if out[s] > most * sizes[s] and s not in full}
        if not above:
            return out
        full |= above


def data():
    out = rows()
    out += [(1000 + i, prose(i, 30 + i % 50), "en", ("big", "big", "tiny", "s2")[i % 4]
             if i % 40 else "rare", 1) for i in range(400)]
    return out


def test_targets_sizes_and_copies(spark):
    got = mixing.mix_sources(documents(spark, data())).collect()
    sizes = defaultdict(int)
    for r in data():
        sizes[r[3]] += len((r[1] or "").encode().split())
    want = plain_targets(sizes)
    taken = defaultdict(int)
    assert len(got) == len(data())
    for r in got:
        assert r["size"] == len((r["text"] or "").encode().split())
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
    for s, t in want.items():
        worst = max(r["size"] for r in got if r["source"] == s)
        assert abs(taken[s] - t) <= max(worst, 0.05 * t)


def test_a_source_stops_at_three_times_its_size(spark):
    rows_ = [(i, "w " * 10, None, "a", 1) for i in range(100)] + [(500, "w w", None, "b", 1)]
    got = mixing.mix_sources(spark.createDataFrame(rows_, SCHEMA)).collect()
    assert {(r["source"], r["target"]) for r in got} == {("a", 996.0), ("b", 6.0)}
    assert [r["copies"] for r in got if r["source"] == "b"] == [3]


def test_reruns_agree_and_rows_come_as_often_as_taken(spark):
    docs = documents(spark, data(), extra=True)
    def multiset(df):
        return sorted((repr(tuple(r)) for r in df.collect()))
    mixed = mixing.mix_sources(documents(spark, data()).repartition(5))
    again = mixing.mix_sources(documents(spark, data()).repartition(3))
    assert multiset(mixed) == multiset(again)
    out = mixing.emit_mix(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r["copies"] for r in mixed.collect())


def test_empty_table(spark):
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0


def test_words_are_counted_once_in_every_pass(spark, monkeypatch):
    plans, real = [], mixing.materialize

    def watched(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(mixing, "materialize", watched)
    mixed = mixing.mix_sources(documents(spark, data()))
    plans.append(mixed._jdf.queryExecution().optimizedPlan().toString())
    assert {p.count("regexp_extract_all") for p in plans} == {0, 1}
